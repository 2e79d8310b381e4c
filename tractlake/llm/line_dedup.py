"""Line dedup: repeated runs of lines, found by distributed prefix doubling over line-id sequences.

Every document is the sequence of its lines that hold a word. A position's rank names the run of `length` lines that starts there; ranks of
twice the length are pairs of ranks, (rank at i, rank at i + length), so log2(min_lines) joins reach runs of min_lines lines (the
last step overlaps if min_lines is no power of two). After each step only ranks that occur more than once go on, which are the
suffix-array intervals whose longest common prefix is at least that length. At the end each interval keeps its first position,
by doc_id and place; the lines of all others are deleted. Runs that overlap or follow each other are one maximal repeated run.
With min_words, shorter runs that hold at least so many words count too, one long line among them; ranks then grow line by line, so that
no length below min_lines is passed over. Longer runs are covered by their parts of min_lines lines.

DataFrame functions only. Defined results: a null text counts as empty; lines without a word are never deleted and don't part a
run; rows without doc_id keep all lines and match nothing; equal rows (doc_id and text) count as one document; an empty table gives
no rows; extra columns are kept by remove_repeats and not looked at. Ranks are 128-bit hashes of what they name, so that no two
of 10^12 lines are likely to share one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm.common import cut, table, unused

MIN_LINES = 3
#: Words from which a run of fewer lines is a repeated passage.
MIN_WORDS = 50
A_WORD = r"[^\x20\x09-\x0D]"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def with_words(lines: Column) -> Column:
    return F.filter(lines, lambda x: x.rlike(A_WORD))


def once(value: Column) -> Column:
    """The same value, worked out once a row: a generator keeps it out of the lambdas and filters that use it."""
    return F.explode(F.array(value))


def name_of(*values: Column | str) -> Column:
    """128 bits that name a line, or a run of runs that have such names."""
    return F.unhex(F.md5(F.concat(*values)))


def repeated(positions: DataFrame) -> DataFrame:
    """The positions(doc_id, h, pos, rank) whose rank occurs again, and later: whether an earlier position has it too."""
    groups = positions.groupBy("rank").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "pos")).alias("first")).where("n > 1")
    found = positions.join(cut(groups).select("rank", "first"), "rank")
    return found.select(*positions.columns, (F.struct("doc_id", "h", "pos") > F.col("first")).alias("later"))


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """(doc_id, h, pos, length, later): where runs of min_lines lines, or of min_words words in fewer lines, start that occur more
    than once; h is a hash of the text."""
    lines = with_words(lines_of(F.col("text")))
    named = lambda x: F.struct(name_of(x).alias("rank"), F.regexp_count(x, F.lit(f"{A_WORD}+")).alias("last"))
    ids = F.posexplode(F.transform(lines, named if min_words else lambda x: F.struct(name_of(x).alias("rank")))).alias("pos", "line")
    active = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("h"), ids)
    active = cut(active.select("doc_id", "h", "pos", "line.*"))
    active = cut(repeated(active).dropDuplicates(["doc_id", "h", "pos"]))
    if min_words:
        active = active.withColumn("words", F.col("last"))
    length, short = 1, []
    while length < min_lines:
        step = 1 if min_words else min(length, min_lines - length)
        ahead = active.select("doc_id", "h", (F.col("pos") - step).alias("pos"), F.col("rank").alias("next"), *([F.col("last").alias("more")] if min_words else []))
        sums = [F.col("more").alias("last"), (F.col("words") + F.col("more")).alias("words")] if min_words else []
        if min_words:
            short.append(active.where(F.col("words") >= min_words).select("doc_id", "h", "pos", F.lit(length).alias("length"), "later"))
        paired = cut(active.join(ahead, ["doc_id", "h", "pos"]).select("doc_id", "h", "pos", name_of("rank", "next").alias("rank"), *sums))
        active = cut(repeated(paired))
        length += step
    found = active.select("doc_id", "h", "pos", F.lit(min_lines).alias("length"), "later")
    for runs in short:
        found = found.unionByName(runs)
    return found


def deleted_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """(doc_id, h, gone): the places, among the lines with a word, that later copies of repeated runs cover."""
    later = repeated_runs(docs, min_lines, min_words).where("later")
    places = F.flatten(F.transform(F.collect_list(F.struct("pos", "length")), lambda p: F.sequence(p["pos"], p["pos"] + p["length"] - 1)))
    return later.groupBy("doc_id", "h").agg(F.array_sort(F.array_distinct(places)).alias("gone"))


def marked(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> tuple[DataFrame, dict[str, str]]:
    """docs with five columns more, and their names: doc (doc_id), gone (places among the lines with a word), all (the lines), kept (those
    that stay)."""
    doc, h, gone, every, spots, stay, kept = names = unused(docs, "doc", "h", "gone", "all", "spots", "stay", "kept")
    deleted = deleted_lines(docs, min_lines, min_words).select(F.col("doc_id").alias(doc), F.col("h").alias(h), F.col("gone").alias(gone))
    keyed = docs.withColumn(h, F.xxhash64("text")).withColumn(doc, F.col("doc_id").cast("long"))
    joined = keyed.join(deleted, [doc, h], "left").withColumn(every, once(lines_of(F.col("text"))))
    places = F.sequence(F.lit(0), F.size(every) - 1)
    with_spots = joined.withColumn(spots, once(F.when(F.col(gone).isNotNull(), F.filter(places, lambda i: F.get(every, i).rlike(A_WORD)))))
    left = F.array_except(places, F.transform(gone, lambda k: F.get(spots, k)))
    with_stay = with_spots.withColumn(stay, once(F.when(F.col(gone).isNotNull(), left)))
    out = with_stay.withColumn(kept, once(F.when(F.col(gone).isNull(), F.col(every)).otherwise(F.transform(stay, lambda i: F.get(every, i)))))
    return out, dict(zip(("doc", "h", "gone", "all", "spots", "stay", "kept"), names, strict=True))


def remove_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """docs, all columns, without the lines of later copies; texts that lose nothing stay as they are, null ones too."""
    found, names = marked(docs, min_lines, min_words)
    text = F.when(F.col(names["gone"]).isNull(), F.col("text")).otherwise(F.array_join(names["kept"], "\n"))
    return found.withColumn("text", text).select(*docs.columns)


def digest(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int | None = None) -> DataFrame:
    """doc_id, n_lines (with a word), n_removed, n_runs (maximal removed runs) and kept_sha256 of each row."""
    found, names = marked(docs.select("doc_id", "text"), min_lines, min_words)
    gone = F.coalesce(F.col(names["gone"]), F.array().cast("array<int>"))
    runs = F.size(F.array_except(gone, F.transform(gone, lambda p: p + 1)))
    return found.select(
        F.col(names["doc"]).alias("doc_id"),
        F.size(with_words(F.col(names["all"]))).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        runs.cast("long").alias("n_runs"),
        F.sha2(F.array_join(names["kept"], "\n"), 256).alias("kept_sha256"),
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


def passages_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1_line_dedup with runs of fewer lines that hold MIN_WORDS words or more."""
    return digest(table(spark, sf_dir, "documents"), min_words=MIN_WORDS)


QUERIES = {"op1_line_dedup": op1_line_dedup, "passages_line_dedup": passages_line_dedup}
ORACLE = {
    "op1_line_dedup": """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS idx FROM documents
), w AS (
  SELECT doc_id, idx, line, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS pos FROM l WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
), k AS (
  SELECT doc_id, pos, line, lead(line, 1) OVER d AS b, lead(line, 2) OVER d AS c FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, pos) AS n FROM k WHERE c IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, pos + s AS pos FROM r, (VALUES (0), (1), (2)) AS steps(s) WHERE n > 1
), kept AS (
  SELECT l.doc_id, l.idx, l.line, w.pos, gone.pos IS NOT NULL AS out
  FROM l LEFT JOIN w ON l.doc_id = w.doc_id AND l.idx = w.idx LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.pos = w.pos
), runs AS (
  SELECT a.doc_id, count(*) AS n FROM gone a WHERE NOT EXISTS (SELECT 1 FROM gone b WHERE b.doc_id = a.doc_id AND b.pos = a.pos - 1) GROUP BY a.doc_id
)
SELECT kept.doc_id, count(pos) AS n_lines, count(*) FILTER (out) AS n_removed, CAST(coalesce(any_value(runs.n), 0) AS BIGINT) AS n_runs,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY idx) FILTER (NOT out), '')) AS kept_sha256
FROM kept LEFT JOIN runs ON runs.doc_id = kept.doc_id GROUP BY kept.doc_id
"""
}
#: The same with runs of one and two lines.
_RUNS = """r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, pos) AS n FROM k WHERE c IS NOT NULL
), gone AS (
  SELECT DISTINCT doc_id, pos + s AS pos FROM r, (VALUES (0), (1), (2)) AS steps(s) WHERE n > 1
)"""
_PASSAGES = f"""r AS (
  SELECT doc_id, pos, 3 AS size, row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, pos) AS n FROM k WHERE c IS NOT NULL
  UNION ALL SELECT doc_id, pos, 2, row_number() OVER (PARTITION BY line, b ORDER BY doc_id, pos) FROM k
    WHERE b IS NOT NULL AND len(regexp_extract_all(line || chr(10) || b, '[^\\x20\\x09-\\x0D]+')) >= {MIN_WORDS}
  UNION ALL SELECT doc_id, pos, 1, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) FROM k
    WHERE len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) >= {MIN_WORDS}
), gone AS (
  SELECT DISTINCT doc_id, pos + s AS pos FROM r, (VALUES (0), (1), (2)) AS steps(s) WHERE n > 1 AND s < size
)"""
ORACLE["passages_line_dedup"] = ORACLE["op1_line_dedup"].replace(_RUNS, _PASSAGES)
