"""Pieces of oracle SQL."""

from __future__ import annotations

from tidewire import fixed_values as fixed

SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACES}', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{SPACES}', ''), '{SPACES}$', '')"


def clean_name(x: str) -> str:
    words = "|".join(fixed.LEGAL_SUFFIXES)
    return collapse(rf"regexp_replace(regexp_replace({x}, '{fixed.NAME_PUNCTUATION}', ' ', 'g'), '(?i)\b({words})\b\.?', ' ', 'g')")


def token_sort(x: str) -> str:
    return f"array_to_string(list_sort(string_split({collapse(x)}, ' ')), ' ')"


def masks(text: str) -> str:
    """Map from character to its positions as bits."""
    chars = f"string_split({text}, '')"
    bits = f"list_sum(list_transform(range(len({chars})), lambda i: CASE WHEN {chars}[i + 1] = c THEN 1::BIGINT << i::INT ELSE 0::BIGINT END))"
    return f"map_from_entries(list_transform(list_distinct({chars}), lambda c: struct_pack(k := c, v := CAST({bits} AS BIGINT))))"


def lcs(text: str, mask_map: str, n: str) -> str:
    """Length of the longest common subsequence by the bit-parallel recurrence; for n up to 61."""
    state = "CAST(s AS BIGINT)"
    hit = f"({state} & coalesce({mask_map}[c], 0::BIGINT))"
    full = f"((1::BIGINT << {n}::INT) - 1)"
    step = f"CAST((({state} + {hit}) | ({state} - {hit})) & {full} AS VARCHAR)"
    last = f"list_reduce(string_split({text}, ''), lambda s, c: {step}, CAST({full} AS VARCHAR))"
    return f"CASE WHEN {text} = '' OR {n} = 0 THEN 0 ELSE {n} - bit_count(CAST({last} AS BIGINT)) END"


def org_name(x: str) -> str:
    words = collapse(f"replace(replace({x}, '-', ' '), '_', ' ')")
    capital = "concat(upper(substring(w, 1, 1)), lower(substring(w, 2)))"
    return (
        f"CASE WHEN coalesce({x}, '') = '' THEN '{fixed.DEFAULT_ORG}' "
        f"ELSE array_to_string(list_transform(string_split({words}, ' '), lambda w: {capital}), ' ') END"
    )


def author(author_col: str = "author", item_id: str = "id") -> str:
    return f"CASE WHEN coalesce({author_col}, '') <> '' THEN {author_col} WHEN contains({item_id}, '/') THEN split_part({item_id}, '/', 1) ELSE {author_col} END"


def product_org(item_id: str = "id") -> str:
    return f"CASE WHEN contains({item_id}, '/') THEN {org_name(f'split_part({item_id}, {chr(39)}/{chr(39)}, 1)')} ELSE '{fixed.DEFAULT_PRODUCT_ORG}' END"


EMPLOYEES = (
    "CASE WHEN downloads > 1000000 THEN 250 WHEN downloads > 100000 OR likes > 500 THEN 50 "
    "WHEN downloads > 10000 THEN 15 END"
)
PRICING = (
    "CASE WHEN tag = 'enterprise' OR likes > 2000 THEN 'ENTERPRISE' WHEN tag = 'commercial' OR likes > 500 THEN 'FREEMIUM' "
    "WHEN tag = 'paid' THEN 'PAID' ELSE 'FREE' END"
)


def role(x: str) -> str:
    t = f"lower({x})"
    return (
        f"CASE WHEN contains({t}, 'engineer') OR contains({t}, 'developer') THEN 'Engineering' "
        f"WHEN contains({t}, 'research') OR contains({t}, 'scientist') THEN 'AI Research' "
        f"WHEN contains({t}, 'product') THEN 'Product Management' ELSE 'Data & AI' END"
    )


def company(x: str) -> str:
    return f"CASE WHEN contains({x}, ':') THEN {strip(f'split_part({x}, {chr(39)}:{chr(39)}, 1)')} ELSE '{fixed.DEFAULT_RSS_COMPANY}' END"


def link(text: str, compat: bool = False, owners: list[str] | None = None) -> str:
    """First repository link of a text, rebuilt; NULL for site pages."""
    pattern = r"(?i)https?://github\.com/([a-zA-Z0-9_-]+)/([a-zA-Z0-9_.-]+)"
    owner, repo = (f"regexp_extract({text}, '{pattern}', {g})" for g in (1, 2))
    if compat:
        repo = f"rtrim({repo}, '.git')"
        usable = f"{owner} <> ''"
    else:
        repo = rf"rtrim(regexp_replace(rtrim({repo}, '.'), '\.git$', ''), '.')"
        usable = f"{owner} <> '' AND {repo} <> ''"
    listed = ", ".join(f"'{o}'" for o in (owners or fixed.GENERIC_OWNERS))
    return f"CASE WHEN {usable} AND lower({owner}) NOT IN ({listed}) THEN concat('{fixed.REPO_URL_PREFIX}', {owner}, '/', {repo}) END"


def clean_html(x: str) -> str:
    blocks = "|".join(rf"<{b}[^>]*>.*?</{b}>" for b in ("script", "style", "svg", "noscript"))
    text = f"regexp_replace({x}, '(?is){blocks}', ' ', 'g')"
    spaces = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
    text = f"""regexp_replace({text}, 'data:image/[^;]+;base64,[^{spaces}"'']+', '', 'g')"""
    return collapse(f"regexp_replace({text}, '<[^>]+>', ' ', 'g')")


def chunk(x: str, n: str) -> str:
    head = f"substring({x}, 1, {n})"
    return rf"CASE WHEN length({x}) <= {n} THEN {x} WHEN contains({head}, '.') THEN regexp_extract({head}, '(?s)^.*\.', 0) ELSE {head} END"
