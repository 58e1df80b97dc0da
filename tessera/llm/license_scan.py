"""Licence scan by canonical digests (DataFrame functions only).

Texts are made canonical: lower case; lines that only state a copyright dropped; every run
of other characters than letters and digits one space; equivalent spellings written one
way. The SHA-256 of canonical texts is then looked up among the digests of known licences,
made canonical by the same expressions, by a hash join. The units that are looked up are
the whole document, its blocks (parted by empty lines), its lines, each as a whole, and runs
of consecutive blocks: where a block is the first of a known text of several blocks, the run
of as many blocks is looked up by the digest of its blocks' digests.

Documents are read once: the digests of their units are written. The table of known
licences is broadcast only if it has at most ``BROADCAST_ROWS`` rows.

Defined results: a null text counts as empty and has no licence; canonical texts that are
empty match nothing; repeated rows and rows with null ids each get their own row; several
identifiers of one canonical text: the smallest is taken; no rows give no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize
from tessera.llm.license_texts import known_licenses

BROADCAST_ROWS = 20_000

#: A line (lower case) that only states a copyright.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}(©\n]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]|:|by |\[|<)|©|\(c\)[ \t]*[0-9]|all rights reserved)[^\n]*$"
#: Equivalent spellings, in canonical text (lower case, no punctuation).
SPELLINGS = [("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"), ("organis", "organiz"), ("authoris", "authoriz"),
             ("recognis", "recogniz"), ("favour", "favor"), ("honour", "honor"), ("behaviour", "behavior"), ("acknowledgement", "acknowledgment"), ("wilful", "willful"),
             ("whilst", "while"), ("copyright owner", "copyright holder"), ("https", "http"), ("per cent", "percent"), ("v 2", "version 2"), ("v 3", "version 3")]


def canonical(text: Column) -> Column:
    """Canonical text with its line breaks."""
    c = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    c = F.regexp_replace(F.replace(c, F.lit("\r"), F.lit("")), COPYRIGHT_LINE, "")
    c = F.replace(c, F.lit("&"), F.lit(" and "))
    c = F.regexp_replace(c, r"[^\p{L}\p{N}\n]+", " ")
    return reduce(lambda x, pair: F.replace(x, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, c)


def unit_digests(text: Column) -> tuple[Column, Column, Column]:
    """Digests of the whole canonical text (null if empty), of its blocks in order, and of its distinct lines; none of empty ones."""
    c = canonical(text)
    one_space = lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))
    digest = lambda x: F.sha2(F.nullif(x, F.lit("")), 256)
    whole = digest(one_space(c))
    blocks = F.transform(F.split(c, r"\n[ \n]*\n"), lambda x: digest(one_space(x)))
    lines = F.transform(F.split(c, r"\n"), lambda x: digest(F.trim(x)))
    return whole, F.array_compact(blocks), F.array_distinct(F.array_compact(lines))


def run_digest(blocks: Column) -> Column:
    return F.sha2(F.array_join(blocks, ","), 256)


def known_digests(licenses: DataFrame) -> DataFrame:
    """(digest, license_id) of a table (license_id, text)."""
    return (licenses.select("license_id", unit_digests(F.col("text"))[0].alias("digest")).where("digest IS NOT NULL")
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def known_runs(licenses: DataFrame, known: DataFrame) -> DataFrame:
    """(first, length, run, license_id) of known texts of several blocks: their first block, how many blocks, the run's digest."""
    whole, blocks, _ = unit_digests(F.col("text"))
    return (licenses.select(whole.alias("digest"), blocks.alias("blocks")).where(F.size("blocks") > 1).join(known, "digest")
            .groupBy(F.col("blocks")[0].alias("first"), F.size("blocks").alias("length"), run_digest(F.col("blocks")).alias("run"))
            .agg(F.min("license_id").alias("license_id")))


def licenses_of_runs(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """(row_id, license_id) of runs of blocks in ``rows`` (row_id, blocks); only blocks that a known text begins with start one."""
    small = runs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    sent = F.broadcast if small else (lambda x: x)
    starts = sent(runs.select(F.col("first").alias("digest"), "length").distinct())
    begun = materialize(rows.select("row_id", F.posexplode("blocks").alias("at", "digest")).join(starts, "digest").select("row_id", "at", "length"), "license-starts")
    # A text's blocks are carried once, however often it repeats a known first block; one of its runs is a known text once.
    of_text = begun.groupBy("row_id").agg(F.collect_list(F.struct("at", "length")).alias("begun"))
    inside = F.filter("begun", lambda r: r["at"] + r["length"] <= F.size("blocks"))
    runs_of_text = F.array_distinct(F.transform(inside, lambda r: F.struct(r["length"].alias("length"), run_digest(F.slice("blocks", r["at"] + 1, r["length"])).alias("run"))))
    found = of_text.join(rows.select("row_id", "blocks"), "row_id").select("row_id", F.explode(runs_of_text).alias("found")).select("row_id", "found.*")
    return found.join(sent(runs.select("run", "length", "license_id")), ["run", "length"]).select("row_id", "license_id")


def scan_licenses(docs: DataFrame, licenses: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, license_ids (distinct, sorted, comma-joined; empty if none), n_licenses, and
    whole_license (of the licence that the whole text is, else null)."""
    spark = docs.sparkSession
    if licenses is None:
        licenses = spark.createDataFrame(known_licenses(), "license_id string, text string")
    known = materialize(known_digests(licenses), "license-digests")
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    runs = materialize(known_runs(licenses, known), "license-runs")
    whole, blocks, lines = unit_digests(F.col("text"))
    rows = materialize(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
                       .select("doc_id", F.monotonically_increasing_id().alias("row_id"), whole.alias("whole"), blocks.alias("blocks"), lines.alias("lines")), "license-units")
    units = F.array_distinct(F.array_compact(F.concat(F.array("whole"), "blocks", "lines")))
    by_unit = (rows.select("row_id", "whole", F.explode(units).alias("digest")).join(known, "digest")
               .select("row_id", "license_id", (F.col("digest") == F.col("whole")).alias("is_whole")))
    found = (by_unit.unionByName(licenses_of_runs(rows, runs).withColumn("is_whole", F.lit(False)))
             .groupBy("row_id").agg(F.array_sort(F.collect_set("license_id")).alias("ids"),
                                    F.min(F.when(F.col("is_whole"), F.col("license_id"))).alias("whole_license")))
    return (rows.select("doc_id", "row_id").join(found, "row_id", "left")
            .select("doc_id", F.coalesce(F.array_join("ids", ","), F.lit("")).alias("license_ids"),
                    F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_licenses"), "whole_license"))
