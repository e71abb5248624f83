"""Catalogues of sources and logs of results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import best_copy, latest
from .stats import stratified


def first_reason(reasons: list[tuple[str, Column]]) -> Column:
    """The name of the first test that holds, or null: why a row is left out."""
    out = F.lit(None).cast("string")
    for name, test in reversed(reasons):
        out = F.when(F.coalesce(test, F.lit(False)), F.lit(name)).otherwise(out)
    return out


#: Licence verdicts by tier (each tier admits those before it), verdicts that no tier admits, and the rank of a repository's state (fixed values).
TIERS = {
    "open": ("OK", "OK (attribution)", "OK (attribution; share-alike)", "OK (copyleft)"),
    "verbatim": ("OK (verbatim; attribution)", "LIKELY OK (verbatim; verify)"),
    "noncommercial": ("OK IF NON-COMMERCIAL", "OK IF NON-COMMERCIAL (verbatim)", "OK IF NON-COMMERCIAL (verify terms)"),
}
NEVER = ("NEEDS PERMISSION", "MANUAL REVIEW", "")
STATES = ("main", "main (Wycliffe partner)", "publisher", "third-party", "third-party (FTP only)", "beta (unreviewed)", "attic (retired/superseded)")


def verdicts_up_to(tier: str) -> list[str]:
    """Licence verdicts are cumulative: a tier admits its own and those of all before it."""
    if tier not in TIERS:
        raise ValueError(f"no licence tier {tier!r}: {', '.join(TIERS)}")
    names = list(TIERS)
    return [v for t in names[: names.index(tier) + 1] for v in TIERS[t]]


def select_rows(
    catalog: DataFrame, tier: str = "open", types: tuple[str, ...] = ("bible",), repositories: list[str] | None = None, ids: list[str] | None = None, sample: int | None = None, limit: int | None = None, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(chosen rows, (reason, n) of the others).

    Rows without an id or a type, of a general repository, or not asked for by
    id do not count at all. Of several copies of an id the one whose
    repository's state ranks first stays, of equals the first in the catalogue
    (``position``). ``sample`` deals rows over repository, versification and
    markup in turn, in hash order.
    """
    text = lambda c: F.btrim(F.coalesce(F.col(c), F.lit("")))
    rows = catalog.where((F.coalesce("module_id", F.lit("")) != "") & (F.coalesce("sword_module_type", F.lit("")) != "") & ~F.coalesce("repository", F.lit("")).startswith("GENERAL"))
    if ids:
        rows = rows.where(F.lower("module_id").isin([i.lower() for i in ids]))
    verdict, kind = text("conversion_license_verdict"), F.coalesce("app_module_type", F.lit(""))
    named = lambda head, c: F.concat(F.lit(head), c)
    reason = F.when(verdict.isin(*NEVER), named("licence: ", F.when(verdict == "", "(none)").otherwise(verdict))).when(~verdict.isin(verdicts_up_to(tier)), named("licence tier: ", verdict))
    reason = reason.when(~kind.isin(*types), named("type: ", F.coalesce("app_module_type", F.lit("None")))).when(text("encrypted") != "", "encrypted")
    if repositories:
        reason = reason.when(~F.col("repository").isin(repositories), "repository filter")
    marked = rows.withColumn("_reason", reason.when(text("zip_download_url") == "", "no zip url"))
    picked = marked.where("_reason IS NULL").drop("_reason")
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, STATES)), F.coalesce("repository_status", F.lit(""))), F.lit(0)), F.lit(10))
    chosen = best_copy(picked, F.lower("module_id"), rank, "position")
    excluded = marked.where("_reason IS NOT NULL").groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("n"))
    twice = picked.agg((F.count("*") - F.countDistinct(F.lower("module_id"))).alias("n")).where("n > 0")
    excluded = excluded.unionByName(twice.select(F.lit("duplicate id (other repository preferred)").alias("reason"), "n"))
    order = ["repository", F.lower("module_id")]
    if sample is not None:
        stratum = F.to_json(F.struct("repository", F.lower(F.coalesce("versification_sword", F.lit(""))).alias("v"), "source_markup"))
        chosen = stratified(chosen.withColumn("_stratum", stratum), "_stratum", "module_id", sample, seed).drop("_stratum")
    return (chosen.orderBy(*order).limit(limit) if limit else chosen), excluded


def masked_reason(x: Column) -> Column:
    """Quoted parts become one sign, at most 90 characters: reasons that differ in a name count together."""
    return F.substring(F.regexp_replace(x, r"'[^']*'|\"[^\"]*\"", "'…'"), 1, 90)


def summary(results: DataFrame) -> dict[str, DataFrame]:
    """Of the latest result of each module: counts by status, of findings (failures and warnings), of reasons."""
    last = latest(results, ["module_id", "repository"], "line_no")
    codes = last.where(F.col("status").isin("FAIL", "WARN")).select(F.explode(F.split("codes", " ")).alias("code")).where("code <> ''")
    return {
        "status": last.groupBy("status").agg(F.count("*").alias("n")),
        "codes": codes.groupBy("code").agg(F.count("*").alias("n")),
        "reasons": last.where("status = 'NOT CONVERTED'").groupBy(masked_reason(F.col("stage")).alias("reason")).agg(F.count("*").alias("n")),
    }
