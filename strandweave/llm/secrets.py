"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Every text is matched against three fixed kinds; tokens of another make that look random are
candidates too.  The digest of each candidate's value is counted over the whole corpus by
distinct repositories and owners.  A value that many owners hold, or several owners in many
repositories, is a copied example; one that stays with its owner looks live however often the
owner copies it.  Base spans are always reported; a random looking token is added to the spans
only if it looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strandweave.llm.common import look_up, text_or_empty
from strandweave.tables import Workspace

# The patterns of the base kinds, in the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

# Twenty characters or more without a blank that mix both cases and digits.
OPAQUE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}"
OPAQUE_NO = 3
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 20

PART = "array<struct<kind_no:int,kind:string,place:int,gap:int,chars:int,digest:string,fits:boolean>>"


def _matches(text: Column, pattern: str, group: int, kind: str, number: int, least: int = 1) -> Column:
    """All matches in order: the length of the piece before each, its own, and its value's digest."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.char_length(piece))
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"), value.alias("value"))
    return F.transform(zipped, lambda part, place: F.struct(
        F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"), place.alias("place"), part["gap"].alias("gap"),
        F.char_length(part["found"]).alias("chars"), F.sha2(part["value"], 256).alias("digest"), (F.char_length(part["value"]) >= least).alias("fits")))


def matches(text: Column) -> Column:
    """Matches of the three kinds and opaque tokens; most texts only meet the cheap tests."""
    none = F.array().cast(PART)
    assigning = (F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))) & F.rlike(text, F.lit(ASSIGN))
    return F.concat(
        F.when(assigning, _matches(text, ASSIGN, 1, "assign", 0, ASSIGN_LEAST)).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), _matches(text, ACCESS, 0, "access", 1)).otherwise(none),
        F.when(F.rlike(text, F.lit(HEX)), _matches(text, HEX, 0, "hex", 2)).otherwise(none),
        F.when(F.rlike(text, F.lit("[A-Za-z0-9+/_-]{20}")), _matches(text, OPAQUE, 0, "opaque", OPAQUE_NO)).otherwise(none))


def placed(rows: DataFrame) -> DataFrame:
    """A row per candidate span, (doc_row, repository, owner, span, digest).

    A match ends where the pieces and matches up to it end, a running sum over its text's matches
    of the kind.  An opaque token that a base span touches is part of that secret and is left out:
    of the base spans that begin no later the furthest end lies beyond its start, or the next one
    begins before its end.
    """
    parts = rows.select("doc_row", "repository", "owner", F.explode("found").alias("m")).select("doc_row", "repository", "owner", "m.*")
    kind = Window.partitionBy("doc_row", "kind_no").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    spans = parts.withColumn("end", F.sum(F.col("gap") + F.col("chars")).over(kind).cast("int")).withColumn("start", F.col("end") - F.col("chars")).where("fits")
    of_base = F.col("kind_no") < OPAQUE_NO
    forth = Window.partitionBy("doc_row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("doc_row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, 0)
    reach, following = F.max(F.when(of_base, F.col("end"))).over(forth), F.min(F.when(of_base, F.col("start"))).over(back)
    touched = (F.coalesce("reach", F.lit(0)) > F.col("start")) | F.coalesce(F.col("following") < F.col("end"), F.lit(False))
    alone = spans.withColumn("reach", reach).withColumn("following", following).where(of_base | ~touched)
    return alone.select("doc_row", "repository", "owner", F.struct("start", "kind_no", "end", "kind").alias("span"), "digest")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")


def scan_secrets(docs: DataFrame, workspace: Workspace, repository: str | Column = "doc_id", owner: str | Column = "source",
                 example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """One row per document: doc_id, counts per kind, base_sha256, spans, n_live, n_example.

    ``spans`` are kind:start:end in code points, end exclusive.  A null text is empty.  A null
    owner or repository counts as one more of its kind.  Repeated rows give repeated results and
    one repository.  An empty table gives no rows.  Only id, text, repository and owner are read.
    """
    named = {c: F.col(c) if isinstance(c, str) else c for c in (repository, owner)}
    text = docs.select(
        F.col("doc_id"), named[repository].cast("string").alias("repository"), named[owner].cast("string").alias("owner"), text_or_empty().alias("text"))
    found = text.select(F.monotonically_increasing_id().alias("doc_row"), "doc_id", "repository", "owner", matches(F.col("text")).alias("found"))
    rows = workspace.write(found, "found")
    candidates = workspace.write(placed(rows), "candidates")

    # One row per digest, repository and owner before anything is counted, so a value that
    # everybody holds is reduced in the tasks and spread over its repositories.
    held = candidates.select("digest", "repository", "owner").distinct()
    owners = held.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
    frequency = owners.groupBy("digest").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repositories"))
    weighed = look_up(candidates.drop("repository", "owner"), frequency, "digest", {"owners": "owners", "repositories": "repositories"}, "doc_row", workspace)
    example = (F.col("owners") >= example_owners) | ((F.col("owners") > 1) & (F.col("repositories") >= example_repositories))
    judged = weighed.select("doc_row", F.col("span").withField("example", example).alias("span"))
    judged = judged.groupBy("doc_row").agg(F.array_sort(F.collect_list("span")).alias("judged"))

    joined = rows.select("doc_row", "doc_id").join(judged, "doc_row", "left")
    found = joined.withColumn("judged", F.coalesce("judged", F.array().cast(judged.schema["judged"].dataType)))
    found = found.withColumn("base", F.filter("judged", lambda s: s["kind_no"] < OPAQUE_NO))
    kept = F.filter("judged", lambda s: (s["kind_no"] < OPAQUE_NO) | ~s["example"])
    return found.select(
        "doc_id", _count("assign"), _count("access"), _count("hex"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(kept).alias("spans"),
        F.size(F.filter("judged", lambda s: ~s["example"])).cast("long").alias("n_live"),
        F.size(F.filter("judged", lambda s: s["example"])).cast("long").alias("n_example"))
