"""Lines that many documents share, taken out of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicspark.llm.columns import SPACES, fresh, lower_ascii, whole
from civicspark.session import materialize


def line_keys(docs: DataFrame, min_chars: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line: the document's id and digest, the position, and the digest of the
    normalised line; lines shorter than ``min_chars`` are left out.

    Lines are normalised inside the array, so that each is normalised once and not again by the
    filter and the digest. Both readers of the table are joins or sums by key, so it is written.
    """
    body = whole(text)
    lines = F.transform(F.split(lower_ascii(body), "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)))
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(body).alias("body"), F.posexplode(lines).alias("pos", "line"))
    return materialize(rows.filter(F.char_length("line") >= min_chars).select("id", "body", "pos", F.unhex(F.md5("line")).alias("key")), "lines")


def common_lines(lines: DataFrame, min_docs: int = 10) -> DataFrame:
    """The digests of lines found in at least ``min_docs`` distinct documents: key, n_docs.

    A line counts once for each document, so the (line, document) pairs are made distinct before
    they are counted; a line of a third of all documents is counted by many tasks.
    """
    found = lines.select("key", "id").distinct()
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= min_docs)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten, and two more columns: n_lines before dropping, n_dropped.

    A text is split at line feeds; a null or empty text is one empty line and stays empty. Lines
    are compared without white space at their ends and without case of A-Z; a key shorter than
    ``min_chars`` is never dropped. Lines whose key is found in at least ``min_docs`` documents go
    everywhere, the rest stay as written, in order. Documents are told apart by their id: rows
    repeating an id count once, null ids count as one document, and every row keeps its own row.
    Only digests and positions are shuffled by line; a text moves once, to meet its positions.
    Columns named n_lines and n_dropped in ``docs`` are replaced.
    """
    keys = line_keys(docs, min_chars, doc_id, text)
    # Written, so that the join has a shuffle on both sides and the rows of a very common line are split.
    common = materialize(common_lines(keys, min_docs).select("key"), "common_lines")
    dropped = keys.join(common, "key", "left_semi").groupBy("id", "body").agg(F.collect_set("pos").alias("gone"))
    p = fresh(docs)
    dropped = dropped.select(*(F.col(c).alias(p + c) for c in dropped.columns))
    rest = docs.select(*(c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")))
    lines = rest.withColumn(p + "lines", F.split(whole(text), "\n", -1))
    met = lines.join(
        dropped, F.col(doc_id).eqNullSafe(F.col(p + "id")) & (F.xxhash64(whole(text)) == F.col(p + "body")), "left"
    )
    last = F.size(p + "lines") - 1
    kept = F.array_except(F.sequence(F.lit(0), last), F.coalesce(p + "gone", F.array().cast("array<int>")))
    met = met.withColumn(p + "kept", kept)
    texts = F.array_join(F.transform(p + "kept", lambda i: F.get(F.col(p + "lines"), i)), "\n")
    return met.select(
        *((F.when(F.col(p + "gone").isNull(), F.col(text)).otherwise(texts).alias(c) if c == text else F.col(c)) for c in rest.columns),
        F.size(p + "lines").cast("long").alias("n_lines"),
        (F.size(p + "lines") - F.size(p + "kept")).cast("long").alias("n_dropped"),
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(whole("text").cast("binary"), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH body AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, unnest(str_split(text, chr(10))) AS line, generate_subscripts(str_split(text, chr(10)), 1) AS pos
  FROM body
),
keyed AS (
  SELECT doc_id, line, pos,
         trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k
  FROM lines
),
common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT doc_id, line, pos, k IN (SELECT k FROM common) AS gone FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
