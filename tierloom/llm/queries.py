"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tierloom.llm import bpe, chat, exact_dedup, lm, ngram_join, packing, periodic, quality, substring_dedup, token_counts, toxicity, vector_codes, vector_dedup
from tierloom.llm.common import table
from tierloom.session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query(
    "op6_exact_dedup",
    r"""WITH n AS (SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
                   FROM documents),
             k AS (SELECT norm, first(doc_id ORDER BY length(t) DESC, doc_id) AS keep_id, count(*) AS group_size
                   FROM n GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN k USING (norm)""",
)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document stays for every one of them."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query("op7_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every text, as digests."""
    return bpe.transcode(table(spark, sf_dir, "documents"), outputs=("n_tokens", "ids_sha256", "decoded_sha256"))

#: Undirected links ``a, b`` to the smallest member that each can reach.
REACH_SQL = "reach(node, root) AS (SELECT a, a FROM links UNION SELECT b, root FROM reach JOIN links ON a = node)"


@query(
    "op1_ngram_jaccard_join",
    r"""WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                lambda x: regexp_replace(lower(x), '[^\p{L}\p{N}]', '', 'g')), lambda x: x <> '') AS ws FROM documents),
        k AS (SELECT doc_id, ws, least(5, len(ws)) AS k FROM w WHERE len(ws) > 0),
        g AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + k - 1) AS gram
              FROM (SELECT *, unnest(range(1, len(ws) - k + 2)) AS i FROM k)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY ALL),
        shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS s FROM g x JOIN g y USING (gram)
                   WHERE x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (SELECT a, b, s = x.n AND s = y.n AS same FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                  WHERE s >= 0.8 * (x.n + y.n - s) - 1e-9),
        {REACH}
        SELECT doc_id, least(doc_id, coalesce(min(root), doc_id)) AS class_id,
               coalesce((SELECT least(doc_id, min(b)) FROM links WHERE a = doc_id AND same), doc_id) AS copy_id,
               (SELECT count(*) FROM links WHERE a = doc_id) AS n_links, doc_id = least(doc_id, coalesce(min(root), doc_id)) AS kept
        FROM documents LEFT JOIN reach ON node = doc_id GROUP BY doc_id""".replace("{REACH}", REACH_SQL),
)
def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("row")


@query("op2_toxicity")
def toxicity_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's score by a machine that learns from labels of two folds of three."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(toxicity.fold_of(F.col("doc_id"), 3) != 1)
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    return scored.select("doc_id", (toxicity.fold_of(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query("op3_token_counts")
def token_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, through a cache that begins empty with each call."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), shared_folder(spark, "token-cache"))


@query("op4_best_two_fit")
def best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), keep_ids=False)


_ESCAPED_SQL = r"""length({0}) + length(regexp_replace({0}, '[^\\]', '', 'g'))
    + len(regexp_extract_all({0}, '<s>|</s>|\[INST\]|\[/INST\]|\[TEXT\]'))"""


@query(
    "op5_chat_formatting",
    f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r))
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(CASE WHEN role = 'assistant' THEN 7 ELSE 22 + {_ESCAPED_SQL.format("role")} END
                   + {_ESCAPED_SQL.format("text")})::BIGINT AS formatted_chars
        FROM c GROUP BY conv_id""",
)
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are full of control strings, formatted and read back."""
    trap = [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(trap, "conv_id long, turn long, role string, text string"))
    return chat.format_conversations(
        rows, outputs=("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    )


@query("op8_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's score by a model of nine folds of ten."""
    return lm.score_texts(table(spark, sf_dir, "documents"), toxicity.fold_of(F.col("doc_id"), 10) == 0)


@query(
    "op9_embedding_near_dedup",
    """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id
                  WHERE list_cosine_similarity(x.e, y.e) >= 0.95),
        {REACH}
        SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
               least(vec_id, coalesce(min(root), vec_id)) AS component_id, vec_id = least(vec_id, coalesce(min(root), vec_id)) AS kept
        FROM embeddings LEFT JOIN reach ON node = vec_id GROUP BY vec_id""".replace("{REACH}", REACH_SQL),
)
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query(
    "op10_substring_dedup",
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
                   FROM documents),
        win AS (SELECT doc_id, i, list_slice(ws, i, i + 34) AS g FROM (SELECT *, unnest(range(1, len(ws) - 33)) AS i FROM w)),
        twice AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM win SEMI JOIN twice USING (g)),
        word AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
        n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
)
def substring_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without its repeated passages."""
    found = substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query("op11_quality_votes")
def quality_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's score by neighbours from three folds of four."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(toxicity.fold_of(F.col("doc_id"), 4) != 2)
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select("doc_id", (toxicity.fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


#: crc32 of a number's decimal digits, bit by bit.
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [-1 - ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: CASE WHEN b < -1 THEN xor(a, (-1 - b)::BIGINT) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295)"""


@query(
    "op12_periodic_runs",
    rf"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                          {_CRC_SQL} AS h FROM documents),
        t AS (SELECT doc_id, len(ws) AS n, h, (h // 10) % greatest(len(ws), 1) AS a, h // 10 AS g FROM w),
        given AS MATERIALIZED (SELECT doc_id, unnest(range(len(ws))) AS i, unnest(ws) AS word FROM w),
        spots AS (SELECT doc_id, i, CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END AS j
                  FROM given JOIN t USING (doc_id)),
        word AS MATERIALIZED (SELECT s.doc_id, s.i, word FROM spots s JOIN given x ON x.doc_id = s.doc_id AND x.i = s.j),
        lag AS (SELECT doc_id, n, unnest(range(1, n // 4 + 1)) AS q FROM t),
        spot AS (SELECT doc_id, q, q * unnest(range(0, (n - 1) // q - 2)) AS i FROM lag),
        h0 AS MATERIALIZED (SELECT s.*, s.i + q AS next, word FROM spot s JOIN word USING (doc_id, i)),
        h1 AS MATERIALIZED (SELECT h.doc_id, q, next + q AS next, h.word FROM h0 h JOIN word x ON x.doc_id = h.doc_id AND x.i = next AND x.word = h.word),
        h2 AS MATERIALIZED (SELECT h.doc_id, q, next + q AS next, h.word FROM h1 h JOIN word x ON x.doc_id = h.doc_id AND x.i = next AND x.word = h.word),
        hit AS MATERIALIZED (SELECT DISTINCT h.doc_id, q FROM h2 h JOIN word x ON x.doc_id = h.doc_id AND x.i = next AND x.word = h.word),
        pair AS MATERIALIZED (SELECT doc_id, q, i, i + q AS next, word FROM hit JOIN word USING (doc_id)),
        edge AS (SELECT p.doc_id, q, p.i FROM pair p JOIN word y ON y.doc_id = p.doc_id AND y.i = next WHERE p.word <> y.word UNION ALL SELECT doc_id, q, -1 FROM hit
                 UNION ALL SELECT doc_id, q, n - q FROM hit JOIN t USING (doc_id)),
        gap AS (SELECT doc_id, q, i AS until, lag(i) OVER (PARTITION BY doc_id, q ORDER BY i) + 1 AS start FROM edge),
        run AS MATERIALIZED (SELECT doc_id, start, until - start + q AS length, min(q) AS period FROM gap
                WHERE until - start + q >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
        best AS (SELECT doc_id, count(*) AS n_runs, arg_max((start, length, period), (length, -start, -period)) AS b,
                 string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM run GROUP BY doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b[1] AS start, b[2] AS length, b[3] AS period,
               1000 * b[2] // b[3] AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
               sha256(coalesce(kept.t, '')) AS collapsed_sha256
        FROM t LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""",
)
def periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every text, after the tenth of the texts that the keys pick was made periodic from some word on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digest = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda word: word != "")
    some = docs.select("doc_id", "text", F.when(digest % 10 == 0, words).alias("ws"), F.floor(digest / 10).alias("g"))
    some = some.withColumn("n", F.size("ws")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    period = F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8))
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    # element_at reads an array by number; F.get would copy the lambda's array for each word
    made = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.element_at("ws", (place(i) + 1).cast("int"))), " ")
    some = some.withColumn("p", period).select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))
    outputs = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return periodic.periodic_runs(some, outputs=outputs)


def _round_sql(i: int) -> str:
    """Assign parts to the entries of round ``i`` and move these; a floor of a quotient of integers takes its remainder off first."""
    return f"""
        a{i} AS MATERIALIZED (SELECT vec_id, part, xs, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
            SELECT vec_id, p.part, xs, entry, list_sum(list_transform(list_zip(xs, cs), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM p JOIN b{i} USING (part)) GROUP BY vec_id, part, xs),
        m{i} AS (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS cs FROM (
            SELECT part, entry, i, sum(xs[i]) AS s, count(*) AS n FROM (SELECT *, unnest(range(1, len(xs) + 1)) AS i FROM a{i}) GROUP BY ALL)
            GROUP BY part, entry),
        b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.cs, b.cs) AS cs FROM b{i} b LEFT JOIN m{i} m USING (part, entry))"""


@query(
    "op13_vector_codes",
    f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS MATERIALIZED (SELECT vec_id, part, list_slice(e, part * len(e) // 8 + 1, (part + 1) * len(e) // 8) AS xs
              FROM (SELECT *, unnest(range(8)) AS part FROM v)),
        b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, xs AS cs FROM (
              SELECT part, xs, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS r FROM p) WHERE r <= 16),
        {",".join(_round_sql(i) for i in range(7))},
        c AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY vec_id)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(cs, ','), ',' ORDER BY part, entry)) FROM b6) AS codebooks_sha256
        FROM c JOIN v USING (vec_id)""",
)
def vector_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
