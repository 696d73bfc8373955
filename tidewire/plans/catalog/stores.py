"""File, graph and vector queries."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tidewire import fixed_values as fixed, model, session
from tidewire.functions import links as fn, names, rules
from tidewire.functions.dates import fmt_iso
from tidewire.operators import dedup, graph, ranking, resolve, search, vectors
from tidewire.plans import fixtures as fx, records
from tidewire.plans.catalog import hub, names as name_queries, papers as paper_queries, signals as signal_queries, sqltext as sql
from tidewire.plans.catalog.signals import _plain
from tidewire.sinks import files
from tidewire.sources import hub as hub_source, tables

c = F.col
DIMS = 64
THRESHOLD = 0.95
#: Cells that a query asks first; queries that the number of probes is tuned on.
PROBES, TUNING_ROWS = 8, 1000


def _startups(spark, sf):
    return records.startups(hub.items(spark, sf), fx.NOW)


def sink_csv_overwrite(spark, sf):
    """Startup records written over product records and read back as text."""
    path = session.fresh_path(spark, "csv") + "/startups"
    files.write_csv(records.products(hub.items(spark, sf), fx.NOW), "PRODUCT", path)
    files.write_csv(_startups(spark, sf), "STARTUP", path)
    return _plain(tables.read_csv(spark, path))


def sink_csv_append(spark, sf):
    """Name mapping in four batches, one of them written twice, after an older run's batch."""
    path = session.fresh_path(spark, "csv") + "/mapping"
    mapping = name_queries._mapping(spark, sf)
    lot = F.pmod(F.length("raw_name"), F.lit(4))
    files.append_csv(mapping, "ENTITY_MAPPING", path, 9, fresh=True)
    files.append_csv(mapping.where(lot == 0), "ENTITY_MAPPING", path, 0, fresh=True)
    for batch in (1, 2, 2, 3):
        files.append_csv(mapping.where(lot == batch), "ENTITY_MAPPING", path, batch)
    stored = tables.read_csv(spark, path)
    return stored.select("raw_name", "canonical_name", "match_type", c("score").cast("double").alias("score"))


def sink_reuse(spark, sf):
    """The second call finds enough products stored and does not run its own plan."""
    path = session.fresh_path(spark, "csv") + "/products"
    all_products = records.products(hub.items(spark, sf), fx.NOW)
    files.reuse_or_compute(spark, path, "PRODUCT", 100, lambda: all_products)
    return _plain(files.reuse_or_compute(spark, path, "PRODUCT", 100, lambda: all_products.limit(0)))


def sink_contract(spark, sf):
    """Products in contract order; columns that the contract lacks are refused."""
    products = records.products(hub.items(spark, sf), fx.NOW)
    try:
        model.to_contract(products.withColumn("extra", F.lit(1)), "PRODUCT")
    except model.ContractError:
        return _plain(model.to_export(products, "PRODUCT"))
    raise AssertionError("a column outside the contract passed")


def src_csv_named(spark, sf):
    """One column of a stored CSV; a missing column and a missing file give no rows."""
    path = session.fresh_path(spark, "csv") + "/startups"
    files.write_csv(_startups(spark, sf), "STARTUP", path)
    wanted = [(path, "content.entityName"), (path, "content.startupName"), (path + "-none", "content.entityName")]
    parts = [tables.csv_column(spark, p, name) for p, name in wanted]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select(c("value").alias("name"))


def src_hub_files(spark, sf):
    """Hub lists from files with one JSON array each."""
    path = session.fresh_path(spark, "hub") + "/lists"
    hub.payloads(spark, sf).select("body").write.text(path)
    # each line is one document: line files hold many arrays, so they are read as text payloads
    rows = hub_source.hub_items(spark.read.text(path).withColumnRenamed("value", "body"))
    return rows.select("item_pos", "id", "author", "downloads", "likes", F.array_join("tags", ",").alias("tags"))


def _kept(df, label):
    """df written once to the shared folder, for what reads it several times."""
    path = session.fresh_path(df.sparkSession, "graph-inputs") + "/" + label
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _graph_inputs(spark, sf):
    items = hub.items(spark, sf)
    dictionary = resolve.dictionary_frame(spark)
    first = dedup.first_seen_orgs(items)
    raw = first.select(names.clean_org_name(c("author")).alias("raw_name"))
    owners = paper_queries.repos(spark, sf).select(c("owner").alias("raw_name"))
    mapping = resolve.resolve_entities(resolve.distinct_names(raw, owners), dictionary)
    organizations = _kept(mapping.select(c("canonical_name").alias("org")), "organizations")
    products = dedup.first_seen_products(items).select(
        rules.hub_url(c("id"), c("list_url")).alias("product_url"), names.product_org(c("id")).alias("org")
    )
    linked = paper_queries._resolved()(spark, sf).withColumn("title", F.concat(F.lit("Paper "), c("doc_id").cast("string")))
    papers = _kept(linked.select(F.concat(F.lit("p/"), c("doc_id").cast("string")).alias("paper_url"), "title", "github_url"), "papers")
    items_ = signal_queries.dated(spark, sf).where("published IS NOT NULL")
    event = c("event_id")
    jobs = items_.select(
        F.concat(F.lit("own"), F.pmod(event, F.lit(70)).cast("string")).alias("org"), fmt_iso(c("published")).alias("date"),
        rules.role_family(c("title")).alias("role_family"),
    )
    news = items_.select(F.concat(F.lit("https://news.example/"), event.cast("string")).alias("url"), "title")
    return organizations, products, papers, jobs, news


def kg_nodes(spark, sf):
    return graph.kg_nodes(*_graph_inputs(spark, sf))


def kg_edges(spark, sf):
    organizations, products, papers, jobs, _ = _graph_inputs(spark, sf)
    return graph.kg_edges(organizations, products, papers, jobs)


def sink_graph(spark, sf):
    """Rows per label and type of the stored graph."""
    path = session.fresh_path(spark, "graph")
    files.write_graph(kg_nodes(spark, sf), kg_edges(spark, sf), path)
    nodes, edges = files.read_graph(spark, path)
    counts = [nodes.groupBy(c("label").alias("kind")), edges.groupBy(c("type").alias("kind"))]
    return counts[0].agg(F.count("*").alias("rows")).unionByName(counts[1].agg(F.count("*").alias("rows")))


def _embeddings(spark, sf):
    return fx.table(spark, sf, "embeddings")


def vector_topk(spark, sf):
    """The five vectors nearest to each label's mean vector."""
    rows = _embeddings(spark, sf)
    means = vectors.label_centroids(rows).select(c("label").alias("vec_id"), c("centroid").alias("embedding"))
    return vectors.vector_topk(rows, means, 5).withColumn("score", F.round("score", 6))


def _searched(spark, sf):
    """The index of all embeddings, the queries (every id divisible by 100) and their ten exact neighbours, stored."""
    path = session.fresh_path(spark, "index")
    rows = _embeddings(spark, sf)
    index = search.build_index(rows, f"{path}/index")
    queries = rows.where("vec_id % 100 = 0")
    search.search_exact(index, queries, 10, PROBES, path).write.parquet(f"{path}/exact")
    return path, index, queries, spark.read.parquet(f"{path}/exact")


def vector_search(spark, sf):
    """The ten vectors nearest to every vector whose id is divisible by 100, by the stored index, exactly."""
    return _searched(spark, sf)[3].withColumn("score", F.round("score", 6))


def vector_index_recall(spark, sf):
    """Whether the index finds nine in ten of the exact neighbours with as many probes as a bounded sample of other queries asks for."""
    path, index, queries, exact = _searched(spark, sf)
    sample = _embeddings(spark, sf).where("vec_id % 100 <> 0").orderBy(F.xxhash64("vec_id")).limit(TUNING_ROWS)
    search.search_exact(index, sample, 10, PROBES, f"{path}/tuning").write.parquet(f"{path}/tuned")
    probes = search.probes_for(index, spark.read.parquet(f"{path}/tuned"), sample, 0.95)
    found = search.recall(search.search(index, queries, 10, probes), exact)
    return found.select("queries", "neighbours", (F.col("recall") >= 0.9).alias("reached"))


def topic_cluster(spark, sf):
    rows = _embeddings(spark, sf)
    assigned = vectors.nearest_centroid(rows, vectors.label_centroids(rows))
    return assigned.select("vec_id", "cluster", F.round("similarity", 6).alias("similarity"))


def topic_kmeans(spark, sf):
    """Ten clusters found from the vectors alone, by what holds of them: all vectors have a cluster, none is empty, and no
    vector is nearer to another cluster's centre."""
    rows = _embeddings(spark, sf).select("vec_id", array_to_vector("embedding").alias("features"))
    fitted = KMeans(k=10, seed=7, distanceMeasure="cosine", maxIter=10).fit(rows)
    placed = fitted.transform(rows).select("vec_id", vector_to_array("features").alias("embedding"), "prediction")
    centres = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(fitted.clusterCenters())], "label int, centroid array<double>")
    nearest = vectors.nearest_centroid(placed, centres)
    own = c("cluster") == c("prediction")
    return nearest.agg(
        F.count("*").alias("vectors"), F.count_distinct("prediction").alias("clusters"), F.count_if(~own).alias("misplaced"))


def semantic_dedup(spark, sf):
    rows = fx.derive(spark, sf, fx.VECTORS, turned=fx.TURNED_SPARK)
    return vectors.semantic_dedup(rows, DIMS, THRESHOLD).select("vec_id", "copy_of")


QUERIES = {
    "sink_csv_overwrite": sink_csv_overwrite,
    "sink_csv_append": sink_csv_append,
    "sink_reuse": sink_reuse,
    "sink_contract": sink_contract,
    "src_csv_named": src_csv_named,
    "src_hub_files": src_hub_files,
    "kg_nodes": kg_nodes,
    "kg_edges": kg_edges,
    "sink_graph": sink_graph,
    "vector_topk": vector_topk,
    "vector_search": vector_search,
    "vector_index_recall": vector_index_recall,
    "topic_cluster": topic_cluster,
    "topic_kmeans": topic_kmeans,
    "semantic_dedup": semantic_dedup,
}

_H = hub._H
_HUB_ADDRESS = "concat('https://huggingface.co/', CASE WHEN contains(list_url, 'spaces') THEN 'spaces/' ELSE '' END, id)"
_STARTUP_CSV = f"""SELECT '1.0' AS "schemaVersion", 'STARTUP' AS "recordType", 'AI Ecosystem Registry' AS source_name,
  concat('https://huggingface.co/', author) AS source_url, {sql.org_name('author')} AS "content_entityName",
  CAST({sql.EMPLOYEES} AS VARCHAR) AS "content_data_employeeCount", '{fx.NOW_ISO}' AS "collectedAt"
  FROM ({hub._first_org(_H, 'src_rank, item_pos')})"""
_PRODUCT_CSV = f"""SELECT '1.0' AS "schemaVersion", 'PRODUCT' AS "recordType", 'AI Product Directory' AS source_name,
  {_HUB_ADDRESS} AS source_url, {sql.product_org()} AS "content_startupName", {sql.PRICING} AS "content_pricingModel",
  '{fx.NOW_ISO}' AS "collectedAt" FROM ({hub._first_product(_H, 'src_rank, item_pos')})"""

_NODE = "sha256(concat('{0}', chr(31), {1}))"
_ORG_NAMES = f"""SELECT {sql.org_name('author')} AS raw_name FROM ({hub._first_org(_H, 'src_rank, item_pos')})
  UNION ALL SELECT owner AS raw_name FROM ({fx.oracle(fx.REPOS)}) AS r"""
_GRAPH = name_queries._resolution(_ORG_NAMES) + f""", orgs AS (SELECT DISTINCT lower(trim(canonical_name)) AS o, canonical_name AS org FROM mapping),
products AS (SELECT {_HUB_ADDRESS} AS product_url, {sql.product_org()} AS org FROM ({hub._first_product(_H, 'src_rank, item_pos')})),
papers AS (SELECT concat('p/', doc_id) AS paper_url, concat('Paper ', doc_id) AS title, github_url FROM ({paper_queries._linked('search_text', 'doc_id')})),
posts AS (SELECT concat('own', ((event_id % 70) + 70) % 70) AS org, strftime(published, {sql.ISO}) AS date, {sql.role('title')} AS role_family,
  concat('https://news.example/', event_id) AS url, title FROM {signal_queries._F} AS f WHERE published IS NOT NULL),
jobs AS (SELECT lower(org) AS o, concat_ws('|', lower(org), date, role_family) AS job, role_family FROM posts),
nodes AS (
  SELECT 'Organization' AS label, o AS key, min(org) AS name FROM orgs WHERE o <> '' GROUP BY o
  UNION ALL SELECT 'Product', product_url, min(product_url) FROM products GROUP BY product_url
  UNION ALL SELECT 'Paper', paper_url, min(title) FROM papers GROUP BY paper_url
  UNION ALL SELECT 'Repository', lower(github_url), lower(github_url) FROM papers WHERE github_url <> '' GROUP BY lower(github_url)
  UNION ALL SELECT 'JobPosting', job, min(role_family) FROM jobs GROUP BY job
  UNION ALL SELECT 'NewsArticle', url, min(title) FROM posts GROUP BY url
), edges AS (
  SELECT DISTINCT 'BUILT' AS type, {_NODE.format('Organization', 'lower(trim(org))')} AS src_id, {_NODE.format('Product', 'product_url')} AS dst_id
    FROM products WHERE lower(trim(org)) IN (SELECT o FROM orgs)
  UNION ALL SELECT DISTINCT 'PUBLISHED', {_NODE.format('Organization', "lower(split_part(github_url, '/', 4))")}, {_NODE.format('Paper', 'paper_url')}
    FROM papers WHERE lower(split_part(github_url, '/', 4)) IN (SELECT o FROM orgs)
  UNION ALL SELECT DISTINCT 'HAS_REPO', {_NODE.format('Paper', 'paper_url')}, {_NODE.format('Repository', 'lower(github_url)')}
    FROM papers WHERE github_url <> ''
  UNION ALL SELECT DISTINCT 'OPENED', {_NODE.format('Organization', 'o')}, {_NODE.format('JobPosting', 'job')}
    FROM jobs WHERE o IN (SELECT o FROM orgs)
)
"""

_UNIT = "(SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
_CENTROIDS = """(SELECT label, list(x ORDER BY spot) AS centroid FROM (
  SELECT label, spot, sum(v[spot]) / count(*) AS x FROM (SELECT label, embedding::DOUBLE[] AS v, unnest(range(1, 65)) AS spot FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"""
# every pair is compared, whatever the engine does to avoid that
_SEMANTIC = f"""WITH vecs AS ({fx.oracle(fx.VECTORS, turned=fx.TURNED_ORACLE)}
), firsts AS (SELECT embedding, embedding::DOUBLE[] AS v, min(vec_id) AS first FROM vecs GROUP BY embedding
), near AS (
  SELECT f.first, min(h.first) AS near FROM firsts AS f JOIN firsts AS h ON h.first < f.first
  WHERE list_cosine_similarity(f.v, h.v) >= {THRESHOLD} GROUP BY f.first
)
SELECT vec_id, CASE WHEN vec_id <> first THEN coalesce(near, first) ELSE near END AS copy_of
FROM vecs JOIN firsts USING (embedding) LEFT JOIN near USING (first)"""

ORACLES = {
    "sink_csv_overwrite": _STARTUP_CSV,
    "sink_csv_append": name_queries.ORACLES["er_resolve"],
    "sink_reuse": _PRODUCT_CSV,
    "sink_contract": _PRODUCT_CSV,
    "src_csv_named": f"SELECT {sql.org_name('author')} AS name FROM ({hub._first_org(_H, 'src_rank, item_pos')})",
    "src_hub_files": f"""SELECT CAST(row_number() OVER (PARTITION BY src_rank, doc_no ORDER BY item_pos) - 1 AS INTEGER) AS item_pos, id, author, downloads, likes, tag AS tags
      FROM (SELECT {hub._DEFAULTED}, CAST(floor(item_pos / {hub.ITEMS_PER_DOC}) AS BIGINT) AS doc_no FROM {_H} AS h)""",
    "kg_nodes": _GRAPH + "SELECT label, sha256(concat(label, chr(31), key)) AS node_id, key, name FROM nodes",
    "kg_edges": _GRAPH + "SELECT type, src_id, dst_id FROM edges",
    "sink_graph": _GRAPH + "SELECT label AS kind, count(*) AS rows FROM nodes GROUP BY 1 UNION ALL SELECT type, count(*) FROM edges GROUP BY 1",
    "vector_topk": f"""SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT CAST(label AS BIGINT) AS query_id, vec_id, list_cosine_similarity(centroid, v) AS score,
        row_number() OVER (PARTITION BY label ORDER BY list_cosine_similarity(centroid, v) DESC, vec_id) AS rank
      FROM {_CENTROIDS} AS q, (SELECT vec_id, v FROM {_UNIT} AS u) AS k) WHERE rank <= 5""",
    "vector_search": f"""SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT q.vec_id AS query_id, k.vec_id, list_cosine_similarity(q.v, k.v) AS score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.v, k.v), 9) DESC, k.vec_id) AS rank
      FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id % 100 = 0) AS q,
        (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings) AS k) WHERE rank <= 10""",
    "vector_index_recall": "SELECT count(*) AS queries, 10 * count(*) AS neighbours, true AS reached FROM embeddings WHERE vec_id % 100 = 0",
    "topic_cluster": f"""SELECT vec_id, cluster, round(similarity, 6) AS similarity FROM (
      SELECT vec_id, c.label AS cluster, list_cosine_similarity(v, centroid) AS similarity,
        row_number() OVER (PARTITION BY vec_id ORDER BY list_cosine_similarity(v, centroid) DESC, c.label) AS nth
      FROM {_UNIT} AS u, {_CENTROIDS} AS c) WHERE nth = 1""",
    "topic_kmeans": "SELECT count(*) AS vectors, 10::BIGINT AS clusters, 0::BIGINT AS misplaced FROM embeddings",
    "semantic_dedup": _SEMANTIC,
}
