"""Fixed values.

Word lists, lookup tables, patterns and thresholds that results depend on.
They are data, not logic: changing one changes the answers.
"""

# Ordered canonical organisation names; the position breaks score ties.
CANONICAL_NAMES = [
    "OpenAI", "Anthropic", "Mistral AI", "Cohere", "Hugging Face", "Stability AI",
    "Midjourney", "Scale AI", "Perplexity AI", "Runway", "DeepSeek", "ElevenLabs",
    "Inflection AI", "Adept AI", "Character.AI", "Black Forest Labs", "Together AI",
    "Anyscale", "Weights & Biases", "Replicate", "Grok xAI", "Pinecone", "Qdrant",
    "Weaviate", "Chroma", "LangChain", "LlamaIndex", "Modal Labs", "Baseten",
    "OctoAI", "Cerebras Systems", "Groq", "SambaNova Systems", "Writer", "Glean",
    "Jasper AI", "Copy.ai", "Synthesia", "Pika Labs", "HeyGen", "Shield AI",
    "Harvey AI", "Tabnine", "Poolside", "Cognition AI", "Magic AI", "Hippocratic AI",
    "EvolutionaryScale", "Cursor", "Deci AI",
]

# Name variants that every mapping run includes.
NAME_VARIANTS = [
    "OpenAI, Inc.", "Open AI", "Anthropic PBC", "Anthropic Labs",
    "Mistral AI Technologies", "Cohere Inc.", "Hugging Face, Inc.",
    "Stability.AI", "DeepSeek-AI", "Scale AI Corp", "Groq, Inc.",
]

# Punctuation and legal-suffix words removed from names.
NAME_PUNCTUATION = "[®™,.]"
LEGAL_SUFFIXES = [
    "inc", "incorporated", "corp", "corporation", "llc", "ltd", "limited", "co", "company",
    "technologies", "technology", "tech", "labs", "lab", "ai", "artificial intelligence",
    "io", "pbc",
]

# Fuzzy tier: lowest accepted score, inclusive.
FUZZY_THRESHOLD = 80.0
MATCHED_TYPES = ["EXACT", "CLEANED_EXACT", "FUZZY"]

# Repository links: owner and name alphabets, and owners that are site pages.
REPO_LINK_PATTERN = r"(?i)https?://github\.com/[a-zA-Z0-9_-]+/[a-zA-Z0-9_.-]+"
REPO_URL_PREFIX = "https://github.com/"
GENERIC_OWNERS = ["topics", "features", "about", "pricing", "explore", "site"]

# Markup removed from pages. Spaces are the Unicode white space of WHITESPACE.
WHITESPACE = r"\s\x1c-\x1f\x85\p{Z}"
HTML_BLOCK_PATTERN = r"(?is)<(script|style|svg|noscript)[^>]*>.*?</\1>"
HTML_IMAGE_PATTERN = "data:image/[^;]+;base64,[^" + WHITESPACE + "\"']+"
HTML_TAG_PATTERN = "<[^>]+>"
CHUNK_CHARS = 4000

# Record envelope.
SCHEMA_VERSION = "1.0"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
FRESH_HOURS = 24
STARTUP_SOURCE = "AI Ecosystem Registry"
PRODUCT_SOURCE = "AI Product Directory"
HUB_URL = "https://huggingface.co/"

# Defaults for missing parts.
DEFAULT_ORG = "AI Innovator"
DEFAULT_PRODUCT_ORG = "Independent"
DEFAULT_JSON_COMPANY = "AI Enterprise"
DEFAULT_RSS_COMPANY = "AI Startup"

# Feed registry in crawl order.
JOB_FEEDS = [
    ("Remotive AI Jobs", "https://remotive.com/api/remote-jobs?category=software-dev&search=AI"),
    ("Remotive Data & ML", "https://remotive.com/api/remote-jobs?category=data"),
    ("Jobicy AI Jobs", "https://jobicy.com/api/v2/remote-jobs?count=50&industry=engineering&tag=ai"),
    ("WeWorkRemotely AI/Backend", "https://weworkremotely.com/categories/remote-back-end-programming-jobs.rss"),
    ("WeWorkRemotely DevOps/Data", "https://weworkremotely.com/categories/remote-devops-sysadmin-jobs.rss"),
]

# Mail-date months and zone names (offset in the form a timestamp cast accepts).
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
ZONE_OFFSETS = {
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
    "AST": "-04:00", "ADT": "-03:00",
}

# Failover: attempts per tier, and the statuses that allow another attempt.
TIER_ATTEMPTS = 3
RETRY_STATUSES = [429, 413]

# Dedup retention.
DEDUP_TTL_DAYS = 7

# Owners of site pages, short form.
SHORT_OWNERS = ["topics", "features", "about", "pricing", "explore"]
