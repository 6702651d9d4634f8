"""Line dedup by winnowing over line hashes (DataFrame functions only).

A window is the shortest run of consecutive lines, from a line on or back
from it, that has at least ``MIN_WORDS`` words (blank lines are not counted).
The smallest line hash of a window is its fingerprint. A run of lines that
occurs twice and has MIN_WORDS words contains equal windows in both places,
and so equal fingerprints: windows whose fingerprint occurs at one position
only are left out. The others are joined by content: a window that occurred
earlier is a repeat. Windows forward and backward of each line extend a match
to both ends of the common run, so exactly the lines that lie in a run of at
least MIN_WORDS words that occurred earlier are deleted. Earlier means a
smaller (doc_id, text hash, line). Each window is compared with the first
occurrence of its content, never pair by pair.

All grouping is by hashes with partial aggregation, and joins on a hash are
salted by document, so a hot line or passage is spread over tasks. Only 64-bit hashes and
positions are shuffled, besides the texts once, to meet their deleted lines.

Results on odd input: null texts stay null and empty ones empty; a text whose
lines all repeat becomes ''; rows that repeat an id and text count as one and
get the same result; null ids come last; lines are compared without the white
space around them; blank lines inside a deleted run go with it; an empty table
gives no rows. When counts are asked for, they replace input columns named
``n_lines`` or ``n_removed``; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farelake.llm.common import discard, stored, text_hash

MIN_WORDS = 50
#: Parts in which a fingerprint or window that many documents share is joined.
SALTS = 64
BLANK = " \t\r"


def line_table(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, th, pos, h, w): hash and words of every line that is not blank, once per row."""
    line = F.trim(F.col("line"), F.lit(BLANK))
    return (docs.where(F.col(text).isNotNull())
            .select(F.col(key).alias("doc_id"), text_hash(text).alias("th"),
                    F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line"))
            .select("doc_id", "th", "pos", F.xxhash64(line).alias("h"),
                    F.size(F.split(line, "[ \t]+", -1)).alias("w"), (line == "").alias("blank"))
            .where(~F.col("blank")).drop("blank")
            .repartition("doc_id", "th").dropDuplicates(["doc_id", "th", "pos"]))


def windows(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, a, b, fp, m, c1, c2): windows of lines a to b, fingerprint fp at line m, content c1, c2."""
    row = Window.partitionBy("doc_id", "th")
    lines = (lines.withColumn("e", F.sum("w").over(row.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("s", F.col("e") - F.col("w")))
    on = row.orderBy("s").rangeBetween(0, min_words - 1)
    back = row.orderBy("e").rangeBetween(1 - min_words, 0)
    least = F.min(F.struct("h", "pos"))

    def window(frame, a, b):
        return F.struct(a.alias("a"), b.alias("b"), F.sum("w").over(frame).alias("words"),
                        least.over(frame).alias("f"), F.collect_list("h").over(frame).alias("hs"))

    both = lines.select("doc_id", "th", window(on, F.col("pos"), F.max("pos").over(on)).alias("x"),
                        window(back, F.min("pos").over(back), F.col("pos")).alias("y"))
    return (both.select("doc_id", "th", F.explode(F.array("x", "y")).alias("x")).where(F.col("x.words") >= min_words)
            .select("doc_id", "th", "x.a", "x.b", F.col("x.f.h").alias("fp"), F.col("x.f.pos").alias("m"),
                    F.xxhash64("x.hs").alias("c1"), F.hash("x.hs").alias("c2")))


def _place(line: str) -> Column:
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", F.col(line).alias("at"))


def _repeated(df: DataFrame, keys: list[str], place: Column) -> DataFrame:
    """(keys, salt, first): the values of ``keys`` that occur at two places or more, with the first.

    ``df`` has a column salt. Counting goes by (keys, salt) first, and the result has a row for each
    salt of a value, so a value that many rows share is joined in as many parts.
    """
    part = df.groupBy(*keys, "salt").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
    full = part.groupBy(*keys).agg(F.min("lo").alias("first"), F.max("hi").alias("hi"),
                                   F.collect_list("salt").alias("salts"))
    return full.where(F.col("first") != F.col("hi")).select(*keys, "first", F.explode("salts").alias("salt"))


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, th, lines): the positions (from 0) of each row's lines to delete.

    The windows are stored once, as three steps read them, and removed when the
    result is stored.
    """
    spark, scratch = docs.sparkSession, []
    wins = stored(spark, windows(line_table(docs, key, text), min_words), "windows", scratch).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "th"), F.lit(SALTS)).cast("int"))
    prints = _repeated(wins, ["fp"], _place("m")).select("fp", "salt")
    wins = wins.join(prints, ["fp", "salt"], "left_semi").select("doc_id", "th", "a", "b", "c1", "c2", "salt")
    first = _repeated(wins, ["c1", "c2"], _place("a"))
    later = wins.join(first, ["c1", "c2", "salt"]).where(_place("a") > F.col("first"))
    runs = later.groupBy("doc_id", "th", "a").agg(F.max("b").alias("b"))
    out = (runs.select("doc_id", "th", F.explode(F.sequence("a", "b")).alias("line"))
           .groupBy("doc_id", "th").agg(F.collect_set("line").alias("lines")))
    out = stored(spark, out, "repeated-lines")
    discard(spark, scratch)
    return out


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS,
                counts: bool = True) -> DataFrame:
    """``docs`` without the later repeats of runs of lines; with ``counts`` adds n_lines and n_removed."""
    names = [c for c in docs.columns if not counts or c not in ("n_lines", "n_removed")]
    gone = repeated_lines(docs, key, text, min_words).select(
        F.col("doc_id").alias("__llm_d"), F.col("th").alias("__llm_t"), F.col("lines").alias("__llm_gone"))
    same = F.col(key).eqNullSafe(F.col("__llm_d")) & (F.col("__llm_th") == F.col("__llm_t"))
    # The rows to clean grow with the documents: a sort-merge join at every size.
    joined = docs.withColumn("__llm_th", text_hash(text)).join(gone.hint("merge"), same, "left")
    lines = F.split(F.col(text), "\n", -1)
    joined = joined.withColumns({
        "__llm_lines": lines,
        "__llm_kept": F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__llm_gone"))})
    clean = F.when(F.col("__llm_gone").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform("__llm_kept", lambda i: F.get(F.col("__llm_lines"), i)), "\n"))
    added = [F.coalesce(F.size("__llm_lines"), F.lit(0)).alias("n_lines"),
             F.when(F.col("__llm_gone").isNull(), 0).otherwise(F.size("__llm_gone")).alias("n_removed")]
    return joined.select(*[clean.alias(c) if c == text else F.col(c) for c in names], *(added if counts else []))


def dedup_sql(docs: str, min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL for ``dedup_lines`` where doc_id is unique: doc_id, text, n_lines, n_removed."""
    return f"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM ({docs})),
l AS (SELECT doc_id, generate_subscripts(ls, 1) - 1 AS pos, trim(unnest(ls), ' ' || chr(9) || chr(13)) AS line FROM d),
w AS (SELECT *, len(string_split_regex(line, '[ \\t]+')) AS w FROM l WHERE line <> ''),
e AS (SELECT *, CAST(sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS BIGINT) AS e FROM w),
s AS (SELECT *, e - w AS s FROM e),
x AS (SELECT doc_id, pos AS a, max(pos) OVER f AS b, sum(w) OVER f AS n, list(line) OVER f AS c FROM s
  WINDOW f AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND {min_words - 1} FOLLOWING)
  UNION ALL SELECT doc_id, min(pos) OVER g, pos, sum(w) OVER g, list(line) OVER g FROM s
  WINDOW g AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN {min_words - 1} PRECEDING AND CURRENT ROW)),
r AS (SELECT *, min({{'d': doc_id, 'a': a}}) OVER (PARTITION BY c) AS first FROM x WHERE n >= {min_words}),
g AS (SELECT doc_id, unnest(range(a, b + 1)) AS pos FROM r WHERE {{'d': doc_id, 'a': a}} > first),
k AS (SELECT doc_id, list(DISTINCT pos) AS gone FROM g GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(
    list_filter(ls, lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text,
  CAST(coalesce(len(ls), 0) AS INTEGER) AS n_lines, CAST(coalesce(len(gone), 0) AS INTEGER) AS n_removed
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""
