"""Line dedup by the spread of a line over distinct sites.

Every line gets one HyperLogLog sketch of the sites it occurs on; sketches merge by aggregation, so
a line costs a row per task however often it occurs. A line whose estimate is above or below the
threshold by more than the sketch's error is decided by it; one near the threshold is decided by an
exact count of distinct sites over its (line, site) pairs. Lines on at least ``min_sites`` sites are
cross-site boilerplate: the occurrence in the first document (smallest doc_id, first line there)
stays, so that no text is lost from the corpus, and all others are removed.

Lines are compared without the white space around them and by their 128-bit MD5 digest. Lines of
fewer than ``min_words`` words stay. Defined cases: NULL text has no lines and stays NULL; a NULL
site is no site; a NULL doc_id comes first; of rows equal in doc_id and text either is the first
occurrence, and both keep it; a text of boilerplate only becomes empty, and its row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import key_of, staged

#: log2 of a sketch's registers; its relative error is about 1.04 / sqrt(registers).
REGISTERS = 10
#: Standard errors around the threshold within which a line's sites are counted exactly.
MARGIN = 4.0
#: Spark's own trim strips spaces only; these are the ASCII white-space characters.
WHITE = " \t\n\r\x0b\x0c"


def _lines(docs: DataFrame, text: str, doc_id: str, site: str, min_words: int) -> DataFrame:
    """(id, hash, at, line, site) of each line long enough, by document and place."""
    line = F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "raw")
    rows = docs.select(key_of(doc_id).alias("id"), F.xxhash64(text).alias("hash"), F.col(site).cast("string").alias("site"), line)
    trimmed = rows.withColumn("raw", F.btrim("raw", F.lit(WHITE)))
    words = F.size(F.split("raw", r"[ \t-\r]+"))
    return trimmed.where(words >= min_words).select("id", "hash", "at", F.unhex(F.md5("raw")).alias("line"), "site")


def boilerplate(lines: DataFrame, min_sites: int, registers: int = REGISTERS, margin: float = MARGIN) -> DataFrame:
    """(line) on at least ``min_sites`` distinct sites."""
    on = lines.where(F.col("site").isNotNull())
    sketch = on.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(registers)).alias("sketch"), F.count("*").alias("n"))
    rated = sketch.where(F.col("n") >= min_sites).select("line", F.hll_sketch_estimate("sketch").alias("sites"))
    rated = staged(rated, "line-sites")
    error = margin * 1.04 / 2 ** (registers / 2)
    clear = rated.where(F.col("sites") > min_sites * (1 + error)).select("line")
    near = rated.where(F.col("sites").between(min_sites * (1 - error) - 1, min_sites * (1 + error))).select("line")
    # distinct pairs first: a frequent line sends one row per task and site
    exact = on.select("line", "site").join(near, "line").distinct().groupBy("line").count()
    return clear.unionAll(exact.where(F.col("count") >= min_sites).select("line"))


def remove_boilerplate(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", site: str = "source", min_sites: int = 8,
    min_words: int = 3, chars: str | None = None,
) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that stay; ``chars`` names a column of its length
    to be kept in step. Only line digests and places are shuffled by line; texts once, by document."""
    lines = _lines(docs, text, doc_id, site, min_words)
    common = staged(boilerplate(lines, min_sites), "boilerplate")
    hits = staged(lines.join(common, "line").select("line", "id", "hash", "at"), "boilerplate-lines")
    place = F.struct("id", "at")
    first = hits.groupBy("line").agg(F.min(place).alias("first"))
    gone = hits.join(first, "line").where(place > F.col("first")).select("id", "hash", "at")
    gone = gone.groupBy("id", "hash").agg(F.collect_set("at").alias("gone"))  # bounded by the text's lines
    rows = docs.select(F.struct(*docs.columns).alias("row"), key_of(doc_id).alias("id"), F.xxhash64(text).alias("hash"))
    before = F.col(f"row.{text}")
    kept = F.filter(F.split(before, "\n", -1), lambda _, i: ~F.array_contains("gone", i))
    after = F.when(F.col("gone").isNull(), before).otherwise(F.array_join(kept, "\n"))
    new = {text: after}
    if chars:
        new[chars] = F.length(after).cast(dict(docs.dtypes)[chars])
    # the documents with removed lines grow with the corpus: one plan for every size
    return rows.join(gone.hint("merge"), ["id", "hash"], "left").select(
        *[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])
