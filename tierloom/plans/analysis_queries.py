"""Queries over drift, experiments, notes, chunks, vectors and prompts."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tierloom.functions.columns import squared_l2
from tierloom.operators import alerts as al
from tierloom.operators import clusters, drift, experiments, keyed, sparse, text, vectors
from tierloom.operators.joins import enrich
from tierloom.plans import testtables as tt
from tierloom.plans.registry import query
from tierloom.session import shared_folder
from tierloom.sources.writers import write_parquet

MEANS_SQL = f"""
    SELECT feature, avg(value) FILTER (WHERE w = 'baseline') AS baseline_mean,
           avg(value) FILTER (WHERE w = 'current') AS current_mean FROM ({tt.LONG_SQL}) GROUP BY feature
"""



def ks_sql(long: str, means: str) -> str:
    """The limiting p-value from the one series that converges for every statistic, with enough terms for all of them."""
    return f"""
    WITH long AS ({long}),
    v AS (SELECT feature, value, count(*) FILTER (WHERE w = 'baseline') AS n,
                 count(*) FILTER (WHERE w = 'current') AS m FROM long GROUP BY feature, value),
    run AS (SELECT feature, sum(n) OVER t AS run_n, sum(m) OVER t AS run_m, sum(n) OVER f AS all_n, sum(m) OVER f AS all_m
            FROM v WINDOW t AS (PARTITION BY feature ORDER BY value), f AS (PARTITION BY feature)),
    stat AS (SELECT feature, max(abs(run_n::DOUBLE / all_n - run_m::DOUBLE / all_m)) AS d,
                    max(all_n)::DOUBLE AS n, max(all_m)::DOUBLE AS m FROM run GROUP BY feature),
    x AS (SELECT *, d * sqrt(n / (n + m) * m) AS x FROM stat),
    p AS (SELECT *, CASE WHEN x = 0 THEN 1.0 WHEN x > 10 THEN 0.0 ELSE greatest(0, least(1, 1 - sqrt(2 * pi()) / x
              * list_sum(list_transform(range(1, 201, 2), lambda o: exp(-o * o * pi() * pi() / (8 * x * x)))))) END AS p FROM x)
    SELECT feature, round(baseline_mean, 6) AS baseline_mean, round(current_mean, 6) AS current_mean,
           round((current_mean - baseline_mean) / baseline_mean * 100, 6) AS pct_change, round(d, 6) AS ks_stat,
           round(p, 6) AS p_value, p < 0.05 AS drift_detected
    FROM p JOIN ({means}) USING (feature)
"""


KS_SQL = ks_sql(tt.LONG_SQL, MEANS_SQL)

REPORT_SQL = f"""
    SELECT *, abs(pct_change) > 30 AS mean_shift_drift, drift_detected OR abs(pct_change) > 30 AS combined_drift
    FROM ({KS_SQL})
"""

ROUNDED = ["baseline_mean", "current_mean", "pct_change"]


@query(
    "drift_mean_shift",
    f"""SELECT feature, round(baseline_mean, 6) AS baseline_mean, round(current_mean, 6) AS current_mean,
        round((current_mean - baseline_mean) / baseline_mean * 100, 6) AS pct_change,
        abs((current_mean - baseline_mean) / baseline_mean * 100) > 30 AS mean_shift_drift FROM ({MEANS_SQL})""",
)
def drift_mean_shift(spark, sf_dir):
    return tt.rounded(drift.mean_shift(tt.windows(spark, sf_dir), "window", tt.NUMERIC), *ROUNDED, digits=6)


@query("drift_ks", KS_SQL)
def drift_ks(spark, sf_dir):
    found = drift.ks_drift(tt.windows(spark, sf_dir), "window", tt.NUMERIC)
    return tt.rounded(found, *ROUNDED, "ks_stat", "p_value", digits=6)


SNAPSHOT_SQL = """
    SELECT w, feature, value FROM (
        SELECT 'baseline' AS w, l_quantity::DOUBLE AS l_quantity, l_extendedprice::DOUBLE AS l_extendedprice FROM lineitem
        UNION ALL
        SELECT 'current', l_quantity + CASE WHEN l_orderkey = (SELECT min(l_orderkey) FROM lineitem) THEN 1 ELSE 0 END,
               l_extendedprice FROM lineitem)
    UNPIVOT (value FOR feature IN (l_quantity, l_extendedprice))
"""
SNAPSHOT_MEANS_SQL = f"""
    SELECT feature, avg(value) FILTER (WHERE w = 'baseline') AS baseline_mean,
           avg(value) FILTER (WHERE w = 'current') AS current_mean FROM ({SNAPSHOT_SQL}) GROUP BY feature
"""


@query("drift_ks_snapshots", ks_sql(SNAPSHOT_SQL, SNAPSHOT_MEANS_SQL))
def drift_ks_snapshots(spark, sf_dir):
    """Two snapshots that differ in the rows of one order: the usual case, and no drift."""
    features = ["l_quantity", "l_extendedprice"]
    before = tt.table(spark, sf_dir, "lineitem").select("l_orderkey", *[F.col(f).cast("double").alias(f) for f in features])
    first = before.agg(F.min("l_orderkey")).first()[0]
    after = before.withColumn("l_quantity", F.col("l_quantity") + (F.col("l_orderkey") == first).cast("int"))
    found = drift.ks_drift(drift.union_windows({"baseline": before, "current": after}), "window", features)
    return tt.rounded(found, *ROUNDED, "ks_stat", "p_value", digits=6)


@query("drift_report", REPORT_SQL)
def drift_report(spark, sf_dir):
    found = drift.combined_drift(tt.windows(spark, sf_dir), "window", tt.NUMERIC)
    return tt.rounded(found, *ROUNDED, "ks_stat", "p_value", digits=6)


@query(
    "drift_summary",
    f"""SELECT ifnull(string_agg(feature, ', ' ORDER BY feature) FILTER (WHERE combined_drift), '') AS drifted_features,
        CASE WHEN bool_or(combined_drift) THEN '{drift.ADVICE}' ELSE '{drift.NO_DRIFT}' END AS advice
        FROM ({REPORT_SQL})""",
)
def drift_summary(spark, sf_dir):
    return drift.drift_summary(drift.combined_drift(tt.windows(spark, sf_dir), "window", tt.NUMERIC))


@query(
    "drift_categorical",
    f"""WITH long AS (SELECT "window" AS w, feature, category FROM ({tt.WINDOWS_SQL})
                      UNPIVOT (category FOR feature IN (l_returnflag, l_linestatus))),
    c AS (SELECT feature, category, count(*) FILTER (WHERE w = 'baseline') AS b,
                 count(*) FILTER (WHERE w = 'current') AS c FROM long GROUP BY ALL)
    SELECT feature, category, round(b * 100.0::DOUBLE / sum(b) OVER f, 6) AS baseline_pct,
           round(c * 100.0::DOUBLE / sum(c) OVER f, 6) AS current_pct FROM c WINDOW f AS (PARTITION BY feature)""",
)
def drift_categorical(spark, sf_dir):
    shares = drift.categorical_drift(tt.windows(spark, sf_dir), "window", tt.CATEGORICAL)
    return tt.rounded(shares, "baseline_pct", "current_pct", digits=6)


@query(
    "describe_by_window",
    f"""SELECT w AS "window", feature, count(*) AS "count", round(avg(value), 4) AS mean, round(stddev(value), 4) AS std,
        min(value) AS "min", round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS q50,
        round(quantile_cont(value, 0.75), 4) AS q75, max(value) AS "max" FROM ({tt.LONG_SQL}) GROUP BY w, feature""",
)
def describe_by_window(spark, sf_dir):
    found = drift.describe(tt.windows(spark, sf_dir), ["window"], tt.NUMERIC)
    return tt.rounded(found, "mean", "std", "q25", "q50", "q75", digits=4)


# --- experiments ---

RUNS = {"threshold_2500000": 2_500_000, "threshold_2000000": 2_000_000, "threshold_1500000": 1_500_000}

SCORED_SQL = f"""
    WITH stg_customers AS ({tt.CUSTOMERS_SQL}), stg_orders AS ({tt.ORDERS_SQL}), signals AS ({tt.SIGNALS_SQL}),
    scored AS (
""" + " UNION ALL ".join(
    f"""SELECT '{name}' AS run_name, customer_id, customer_name, total_spend, pending_orders, cancelled_orders,
        {tt.pick_sql(tt.REASONS, tt.priority_sql(threshold))} AS alert_reason FROM stg_customers LEFT JOIN signals USING (customer_id)"""
    for name, threshold in RUNS.items()
) + ")"


def scoring(spark, sf_dir):
    return experiments.scoring_input(tt.customers(spark, sf_dir), al.order_signals(tt.orders(spark, sf_dir)))


@query(
    "threshold_sweep",
    SCORED_SQL
    + """SELECT run_name, replace(run_name, 'threshold_', '') AS high_value_threshold,
         count(*) FILTER (WHERE alert_reason = 'high_value_customer')::DOUBLE AS high_value_customer_count,
         count(*)::DOUBLE AS total_customers_scored FROM scored GROUP BY run_name""",
)
def threshold_sweep(spark, sf_dir):
    runs = experiments.threshold_sweep(scoring(spark, sf_dir), RUNS)
    return runs.select(
        "run_name",
        F.col("params")["high_value_threshold"].alias("high_value_threshold"),
        F.col("metrics")["high_value_customer_count"].alias("high_value_customer_count"),
        F.col("metrics")["total_customers_scored"].alias("total_customers_scored"),
    )


@query(
    "threshold_sweep_table",
    f"""WITH stg_customers AS ({tt.CUSTOMERS_SQL}), stg_orders AS ({tt.ORDERS_SQL}), signals AS ({tt.SIGNALS_SQL}),
        s AS (SELECT coalesce(total_spend, 0) AS spend FROM stg_customers LEFT JOIN signals USING (customer_id)),
        runs AS (SELECT 'nation_' || c_nationkey || '_' || c_mktsegment AS run_name, max(c_acctbal) * 500 AS threshold FROM customer GROUP BY ALL)
        SELECT run_name, threshold, count(*) FILTER (WHERE spend > threshold) AS hits, count(*) AS customers
        FROM runs, s GROUP BY run_name, threshold""",
)
def threshold_sweep_table(spark, sf_dir):
    """Thresholds from a table: one per nation and segment, by the largest balance there."""
    runs = tt.table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.max("c_acctbal").alias("most"))
    runs = runs.select(F.concat(F.lit("nation_"), F.col("c_nationkey"), F.lit("_"), F.col("c_mktsegment")).alias("run_name"),
                       (F.col("most") * 500).alias("threshold"))
    return experiments.sweep_table(scoring(spark, sf_dir), runs)


@query(
    "scored_by_run",
    SCORED_SQL
    + """SELECT run_name, customer_id, customer_name, round(total_spend, 2) AS total_spend, pending_orders,
         cancelled_orders, alert_reason FROM scored""",
)
def scored_by_run(spark, sf_dir):
    return tt.rounded(experiments.scored_by_run(scoring(spark, sf_dir), RUNS), "total_spend")


@query(
    "run_diff",
    SCORED_SQL
    + """SELECT customer_id, a.alert_reason AS alert_a, b.alert_reason AS alert_b
         FROM (SELECT * FROM scored WHERE run_name = 'threshold_2500000') a
         JOIN (SELECT * FROM scored WHERE run_name = 'threshold_2000000') b USING (customer_id)
         WHERE a.alert_reason <> b.alert_reason""",
)
def run_diff(spark, sf_dir):
    return experiments.threshold_diff(scoring(spark, sf_dir), RUNS, "threshold_2500000", "threshold_2000000")


# --- notes and chunks ---


def notes(spark, sf_dir):
    return text.alert_notes(al.customer_targets(tt.alerts(spark, sf_dir), ranked=False))


def template_sql(template: str) -> str:
    """The columns of a note put into its text."""
    filled = re.sub(r"\{\$(\w+)\}", r"$' || \1::DECIMAL(18, 2) || '", template)
    return "'" + re.sub(r"\{(\w+)\}", r"' || \1 || '", filled) + "'"


NOTES_SQL = " ".join(f"WHEN '{alert}' THEN {template_sql(note)}" for alert, note in text.NOTE_TEXTS.items())


@query(
    "alert_notes",
    tt.alerts_sql(tt.THRESHOLD)
    + f"""SELECT 'alert_note_' || customer_id AS note_id, customer_id, region, target_tier,
          CASE alert_reason {NOTES_SQL} ELSE {template_sql(text.NOTE_OTHERWISE)} END AS alert_note FROM targets""",
)
def alert_notes(spark, sf_dir):
    return notes(spark, sf_dir).select("note_id", "customer_id", "region", "target_tier", "alert_note")


def level_sql(level: int, separator: str, size: int, overlap: int) -> str:
    """The pieces of texts that reach a level of the splitter, and their chunks.

    ``p0`` and ``p1`` are where a piece begins and ends in its text. Pieces of a full chunk's size go to the next level. Runs of
    shorter ones are packed: ``n`` gives for every first piece where its chunk ends and with which piece the next one begins, and
    ``r`` follows that from the first piece of a run on.
    """
    sep = "''" if not separator else " || ".join(f"'{c}'" if c.isprintable() else f"chr({ord(c)})" for c in separator)
    split = f"string_split(text, {sep})"
    pieces = split if not separator else f"list_prepend({split}[1], list_transform({split}[2:], lambda x: {sep} || x))"
    here = "true" if not separator else f"contains(text, {sep})"
    return f"""
    p{level} AS (SELECT doc_id, path, text, unnest(range(len(ps))) AS j, unnest(ps) AS piece
           FROM (SELECT *, {pieces} AS ps FROM in{level} WHERE {here})),
    o{level} AS MATERIALIZED (SELECT *, p1 - length(piece) AS p0, length(piece) >= {size} AS long,
           count(*) FILTER (WHERE length(piece) >= {size}) OVER (PARTITION BY doc_id, path ORDER BY j) AS run_no FROM (
           SELECT doc_id, path, j, piece, sum(length(piece)) OVER (PARTITION BY doc_id, path ORDER BY j) AS p1
           FROM p{level} WHERE piece <> '')),
    in{level + 1} AS MATERIALIZED (SELECT doc_id, path, text FROM in{level} WHERE NOT {here}
           UNION ALL SELECT doc_id, list_append(path, j), piece FROM o{level} WHERE long),
    q{level} AS MATERIALIZED (SELECT *, min(g) OVER w AS run, max(p1) OVER w AS run_end FROM (
           SELECT doc_id, path, j, p0, p1, run_no, row_number() OVER (ORDER BY doc_id, path, j) AS g FROM o{level} WHERE NOT long)
           WINDOW w AS (PARTITION BY doc_id, path, run_no)),
    full{level} AS (SELECT a.run, a.g, b.p0 AS until, greatest(b.p0 - {overlap}, b.p1 - {size}) AS since
           FROM q{level} a ASOF JOIN q{level} b ON a.run = b.run AND a.p0 + {size} < b.p1),
    n{level} AS MATERIALIZED (SELECT f.g, until, c.g AS next FROM full{level} f ASOF JOIN q{level} c ON f.run = c.run AND since <= c.p0),
    r{level} AS (SELECT DISTINCT run AS g FROM q{level} UNION ALL SELECT next FROM r{level} JOIN n{level} USING (g)),
    out{level} AS (SELECT doc_id, list_append(path, j) AS place, substring(text, p0::BIGINT + 1, (coalesce(until, run_end) - p0)::BIGINT) AS chunk
           FROM r{level} JOIN q{level} USING (g) LEFT JOIN n{level} USING (g) JOIN in{level} USING (doc_id, path))"""


RECURSIVE_SQL = f"""
    WITH RECURSIVE in0 AS (SELECT doc_id, []::BIGINT[] AS path, text FROM documents WHERE text <> ''),
    {",".join(level_sql(i, sep, text.CHUNK_SIZE, text.CHUNK_OVERLAP) for i, sep in enumerate(text.SEPARATORS))},
    found AS (SELECT doc_id, place, regexp_replace(chunk, '^\\s+|\\s+$', '', 'g') AS chunk_text FROM (
              {" UNION ALL ".join(f"SELECT * FROM out{i}" for i in range(len(text.SEPARATORS)))})),
    numbered AS (SELECT doc_id, chunk_text, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS chunk_index,
                        count(*) OVER (PARTITION BY doc_id) AS total_chunks FROM found WHERE chunk_text <> '')
    SELECT doc_id || '#' || chunk_index AS chunk_id, doc_id, chunk_index::INTEGER AS chunk_index, total_chunks::INTEGER AS total_chunks,
           (chunk_index + 1) || '/' || total_chunks AS chunk_label, chunk_text FROM numbered"""


@query("chunk_recursive", RECURSIVE_SQL)
def chunk_recursive(spark, sf_dir):
    return text.chunk_recursive(tt.table(spark, sf_dir, "documents"), "doc_id", "text")


CHUNKS_SQL = """WITH c AS (SELECT doc_id, source, unnest(range(0, length(text), 340)) AS pos, text FROM documents),
    n AS (SELECT doc_id, source, pos // 340 AS chunk_index, substring(text, pos + 1, 400) AS chunk_text,
                 count(*) OVER (PARTITION BY doc_id) AS total_chunks FROM c)
    SELECT doc_id || '#' || chunk_index AS chunk_id, doc_id, source, chunk_index::INTEGER AS chunk_index,
           total_chunks::INTEGER AS total_chunks, (chunk_index + 1) || '/' || total_chunks AS chunk_label, chunk_text FROM n"""


@query("chunk_fixed", f"SELECT * EXCLUDE source FROM ({CHUNKS_SQL})")
def chunk_fixed(spark, sf_dir):
    return text.chunk_fixed(tt.table(spark, sf_dir, "documents"), "doc_id", "text")


# --- vectors ---


TOKENS_SQL = r"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def counts_sql(source: str, key: str, text: str) -> str:
    """Signed counts per bucket of each text, and their length."""
    return f"""
    SELECT {key}, bucket, c, sqrt(sum(c * c) OVER (PARTITION BY {key})) AS norm FROM (
        SELECT {key}, (('0x' || substr(md5(t), 1, 8))::BIGINT % {vectors.HASH_DIM})::INTEGER AS bucket,
               sum(CASE WHEN substr(md5(t), 9, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS c
        FROM (SELECT {key}, unnest({TOKENS_SQL.format(text=text)}) AS t FROM ({source})) GROUP BY ALL)
    WHERE c <> 0
    """


def search_sql(stored: str, key: str, text: str, questions: dict[str, str], payload: str, limit: str = "true") -> str:
    """The three nearest texts of each question, over unit vectors of signed counts; a text without counts has none."""
    asked = " UNION ALL ".join(f"SELECT '{name}' AS query_id, '{words}' AS query_text" for name, words in questions.items())
    return f"""
    WITH stored AS ({stored}),
    s AS (SELECT {key}, bucket, (c / norm)::FLOAT::DOUBLE AS x FROM ({counts_sql("SELECT * FROM stored", key, text)})),
    q AS (SELECT query_id, bucket, (c / norm)::FLOAT::DOUBLE AS y FROM ({counts_sql(asked, "query_id", "query_text")})),
    pairs AS (SELECT * FROM (SELECT query_id, sum(y * y) AS yy FROM q GROUP BY ALL), (SELECT {key}, sum(x * x) AS xx FROM s GROUP BY ALL)),
    dots AS (SELECT query_id, {key}, sum(x * y) AS xy FROM q JOIN s USING (bucket) GROUP BY ALL),
    far AS (SELECT query_id, {key}, round(xx + yy - 2 * coalesce(xy, 0), 9) AS d FROM pairs LEFT JOIN dots USING (query_id, {key})),
    hits AS (SELECT query_id, {key}, round(d, 4) AS distance, row_number() OVER (PARTITION BY query_id ORDER BY d, {key}) AS rank
             FROM far QUALIFY rank <= 3)
    SELECT query_id, rank, {key}, distance, {payload} FROM hits JOIN stored USING ({key}) WHERE {limit}
    """


@query(
    "embed_hash",
    f"""SELECT doc_id, bucket, round((c / norm)::FLOAT::DOUBLE, 6) AS value
        FROM ({counts_sql("SELECT * FROM documents", "doc_id", "text")})""",
)
def embed_hash(spark, sf_dir):
    """The vector of every document, as its parts that are not zero."""
    embedded = sparse.embed_sparse(tt.table(spark, sf_dir, "documents"), "text", keep=["doc_id"])
    parts = embedded.select("doc_id", F.explode("sparse").alias("part"))
    return parts.select("doc_id", "part.bucket", F.round(F.col("part.value").cast("double"), 6).alias("value"))


@query(
    "vector_distance",
    f"""SELECT vec_id, label, round(list_distance(embedding::DOUBLE[], query_vector) ** 2, 4) AS distance
        FROM embeddings JOIN ({tt.CENTROIDS_SQL}) ON label = query_id""",
)
def vector_distance(spark, sf_dir):
    """Distance of each vector to the mean of its label. There are few labels, which is checked before a broadcast."""
    centers = tt.centroids(spark, sf_dir).withColumnRenamed("query_id", "label")
    placed = enrich(tt.table(spark, sf_dir, "embeddings"), centers, "label", broadcast=True, max_rows=10_000)
    return placed.select("vec_id", "label", F.round(squared_l2("embedding", "query_vector"), 4).alias("distance"))


def hits_sql(where: str = "true") -> str:
    return f"""
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY d, vec_id) AS rank, vec_id, round(d, 4) AS distance
    FROM (SELECT query_id, vec_id, list_distance(embedding::DOUBLE[], query_vector) ** 2 AS d
          FROM ({tt.CENTROIDS_SQL}), embeddings WHERE {where})
    QUALIFY rank <= 3
    """


def typed(hits):
    return hits.withColumn("rank", F.col("rank").cast("bigint"))


@query("retrieve_topk", hits_sql())
def retrieve_topk(spark, sf_dir):
    return typed(vectors.retrieve(tt.centroids(spark, sf_dir), tt.table(spark, sf_dir, "embeddings")))


@query("retrieve_filtered", hits_sql("label = 3"))
def retrieve_filtered(spark, sf_dir):
    hits = vectors.retrieve(
        tt.centroids(spark, sf_dir), tt.table(spark, sf_dir, "embeddings"), where=F.col("label") == 3
    )
    return typed(hits)


#: Keeps some of the hits, so that questions with and without context appear.
MAX_DISTANCE = 0.91


@query("retrieve_threshold", f"SELECT * FROM ({hits_sql()}) WHERE distance <= {MAX_DISTANCE}")
def retrieve_threshold(spark, sf_dir):
    hits = vectors.retrieve(
        tt.centroids(spark, sf_dir), tt.table(spark, sf_dir, "embeddings"), max_distance=MAX_DISTANCE
    )
    return typed(hits)


def bucketed_vectors(spark, sf_dir, bits):
    stored = vectors.with_buckets(tt.table(spark, sf_dir, "embeddings"), 64, bits=bits)
    return spark.read.parquet(write_parquet(stored, shared_folder(spark, "vector_buckets"), partition_by=["bucket"]))


#: Of 2048 buckets a question sees these, about 70 percent: what nine of ten exact hits cost on vectors without close neighbours.
LSH_BITS, LSH_PROBES = 11, 1434


@query("retrieve_lsh")
def retrieve_lsh(spark, sf_dir):
    """The approximate search; how much of the exact result it finds is tested.

    So many buckets hold few vectors each and together the questions see all, so the table has no folder per bucket.
    """
    placed = vectors.with_buckets(tt.table(spark, sf_dir, "embeddings"), 64, bits=LSH_BITS)
    placed = stored(spark, placed, "vector_buckets")
    return typed(vectors.retrieve_lsh(tt.centroids(spark, sf_dir), placed, bits=LSH_BITS, probes=LSH_PROBES))


@query("retrieve_lsh_all_buckets", hits_sql())
def retrieve_lsh_all_buckets(spark, sf_dir):
    """The same join with a radius that reaches every bucket: the exact hits."""
    stored = bucketed_vectors(spark, sf_dir, 5)
    return typed(vectors.retrieve_lsh(tt.centroids(spark, sf_dir), stored, radius=5, bits=5))


@query("retrieve_clusters", hits_sql())
def retrieve_clusters(spark, sf_dir):
    """The exact hits over an index of clusters, which the triangle inequality prunes."""
    index = clusters.build_clusters(tt.table(spark, sf_dir, "embeddings"))
    return typed(clusters.retrieve_clusters(tt.centroids(spark, sf_dir), index))


def stored(spark, df, purpose):
    """A collection is written once and then searched; its text is read only for the hits."""
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)


def asked(spark, **questions):
    """Questions with their vectors; one without a known word has none and is left out."""
    rows = spark.createDataFrame(list(questions.items()), "query_id string, query_text string")
    return sparse.embed_sparse(rows, "query_text", vector_col="query_vector").where(F.size("query_vector") > 0)


def searchable(spark, rows, id_col, text_col, by=()):
    """Stored posting lists of the texts of ``rows``."""
    return stored(spark, sparse.text_postings(rows, id_col, text_col, by), "postings")


NOTE_QUESTIONS = {
    "q1": "Which customers need retention outreach due to cancellations?",
    "q2": "Who are our highest value accounts to prioritize?",
}
NOTES_TABLE_SQL = (
    tt.alerts_sql(tt.THRESHOLD)
    + f"""SELECT 'alert_note_' || customer_id AS note_id, customer_name, region, target_tier,
          CASE alert_reason {NOTES_SQL} ELSE {template_sql(text.NOTE_OTHERWISE)} END AS alert_note FROM targets"""
)


@query(
    "note_search",
    search_sql(f"SELECT * FROM ({NOTES_TABLE_SQL}) WHERE region = 'asia'", "note_id", "alert_note", NOTE_QUESTIONS,
               "customer_name, target_tier, alert_note"),
)
def note_search(spark, sf_dir):
    """Questions over the notes of all customers in one region."""
    collection = stored(spark, keyed.collection_add(None, notes(spark, sf_dir), "note_id"), "notes")
    return typed(
        sparse.retrieve_sparse(
            asked(spark, **NOTE_QUESTIONS),
            searchable(spark, collection, "note_id", "alert_note", ["region"]),
            where=F.col("region") == "asia",
            id_col="note_id",
            rows=collection,
            payload=["customer_name", "target_tier", "alert_note"],
        )
    )


#: The last question has no word of any document.
CHUNK_QUESTIONS = {"q1": "that heron in the", "q2": "le la des que", "q3": "zzzz"}


def chunk_hits(spark, chunks, id_col="chunk_id", payload=("source", "chunk_label", "chunk_text"), text_col="chunk_text"):
    collection = stored(spark, chunks, "chunks")
    return typed(
        sparse.retrieve_sparse(
            asked(spark, **CHUNK_QUESTIONS), searchable(spark, collection, id_col, text_col), id_col=id_col,
            max_distance=vectors.MAX_DISTANCE, rows=collection, payload=list(payload),
        )
    )


@query(
    "chunk_search",
    search_sql(f"SELECT c.*, source FROM ({RECURSIVE_SQL}) c JOIN documents USING (doc_id)", "chunk_id", "chunk_text", CHUNK_QUESTIONS,
               "source, chunk_label, chunk_text", f"distance <= {vectors.MAX_DISTANCE}"),
)
def chunk_search(spark, sf_dir):
    """Documents split, embedded and stored; questions find the chunks that share most words with them."""
    return chunk_hits(spark, text.chunk_recursive(tt.table(spark, sf_dir, "documents"), "doc_id", "text", keep=["source"]))


@query(
    "chunk_search_fixed",
    search_sql(CHUNKS_SQL, "chunk_id", "chunk_text", CHUNK_QUESTIONS,
               "source, chunk_label, chunk_text", f"distance <= {vectors.MAX_DISTANCE}"),
)
def chunk_search_fixed(spark, sf_dir):
    """The same over fixed windows of all documents."""
    return chunk_hits(spark, text.chunk_fixed(tt.table(spark, sf_dir, "documents"), "doc_id", "text", keep=["source"]))


@query(
    "document_search",
    search_sql("SELECT * FROM documents", "doc_id", "text", CHUNK_QUESTIONS, "source, lang",
               f"distance <= {vectors.MAX_DISTANCE}"),
)
def document_search(spark, sf_dir):
    """Whole documents as a stored collection, searched with the same questions."""
    return chunk_hits(spark, tt.table(spark, sf_dir, "documents"), "doc_id", ["source", "lang"], "text")


@query(
    "chunk_recursive_checks",
    r"""SELECT doc_id, list_unique(list_filter(regexp_split_to_array(text, '[.\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS words,
        0::BIGINT AS lost, 0::BIGINT AS too_long, 0::BIGINT AS not_in_text
        FROM documents WHERE regexp_matches(text, '[^.\x20\x09-\x0D]')""",
)
def chunk_recursive_checks(spark, sf_dir):
    """Chunks against their documents: no word is lost (a full stop may go to the next chunk), none is longer than allowed, and each stands in its text."""
    documents = tt.table(spark, sf_dir, "documents").select("doc_id", "text")
    chunks = text.chunk_recursive(documents, "doc_id", "text")
    per_document = chunks.groupBy("doc_id").agg(F.collect_list("chunk_text").alias("chunks"))  # one document's chunks

    def words(column):
        return F.array_distinct(F.array_remove(F.split(column, r"[.\x20\x09-\x0D]+"), ""))

    held = words(F.array_join("chunks", " "))
    return documents.where(F.col("text").rlike(r"[^.\x20\x09-\x0D]")).join(per_document, "doc_id", "left").select(
        "doc_id",
        F.size(words(F.col("text"))).cast("bigint").alias("words"),
        F.size(F.array_except(words(F.col("text")), held)).cast("bigint").alias("lost"),
        F.size(F.filter("chunks", lambda c: F.length(c) > text.CHUNK_SIZE)).cast("bigint").alias("too_long"),
        F.size(F.filter("chunks", lambda c: ~F.col("text").contains(c))).cast("bigint").alias("not_in_text"),
    )


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@query(
    "grounded_prompts",
    f"""WITH q AS (SELECT query_id, 'What do the documents of topic ' || query_id || ' say?' AS query_text
                   FROM ({tt.CENTROIDS_SQL})),
    h AS (SELECT query_id, string_agg('[' || source || ']: ' || text, chr(10) || chr(10) ORDER BY rank) AS context,
                 string_agg(source, ', ' ORDER BY rank) AS sources
          FROM ({hits_sql()}) JOIN documents ON doc_id = vec_id WHERE distance <= {MAX_DISTANCE} GROUP BY query_id)
    SELECT query_id, query_text, {quoted(text.PROMPT_HEAD)} || context || chr(10) || chr(10) || 'Question: ' || query_text
           || chr(10) || chr(10) || 'Answer:' AS prompt,
           CASE WHEN context IS NULL THEN {quoted(text.NO_ANSWER)} END AS answer,
           coalesce(sources, '') AS sources
    FROM q LEFT JOIN h USING (query_id)""",
)
def grounded_prompts(spark, sf_dir):
    """One question per label; the texts behind the nearest vectors are its context."""
    centers = tt.centroids(spark, sf_dir)
    hits = vectors.retrieve(centers, tt.table(spark, sf_dir, "embeddings"), max_distance=MAX_DISTANCE)
    documents = tt.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "source", "text")
    hits = documents.join(hits, "vec_id")  # every vector is searched; a hit without a document gives no context
    questions = centers.select(
        "query_id",
        F.concat(F.lit("What do the documents of topic "), F.col("query_id").cast("string"), F.lit(" say?")).alias(
            "query_text"
        ),
    )
    return text.grounded_prompts(questions, hits).withColumn("sources", F.array_join("sources", ", "))
