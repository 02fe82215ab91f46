"""Secret scan with corpus-wide ownership frequency (DataFrame operations only).

Patterns find candidate secrets with their places. The hash of each candidate value is counted over the corpus by
distinct owners and distinct repositories. A value that several owners or many repositories hold is a widely copied
example. One that a single owner holds is live if it also looks so: long enough, of letters and digits, of several
characters, without a placeholder's words. All spans of the base kinds are reported; spans of the further kinds
(`other`: tokens of known services, private keys) are reported unless they are examples.

Places come from the text between matches, so each pattern is applied as it stands: leftmost, not overlapping. Places
count code points, ends are exclusive. Counts take distinct (value, owner, repository) rows first, so a value that is
everywhere costs each task one row. Values leave the scan as digests only.

Defined cases: null text counts as empty; a text without spans has empty `spans` and the digest of the empty string;
a null owner or repository counts as one of its own; rows that repeat are counted as rows of the same owner; an
empty table gives an empty result. Columns other than doc_id, text, owner and repository are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from locusweave.llm.common import join_hot, saved


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = rf"""({"|".join(map(_either, KEYWORDS))})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: name, pattern, least length; matches of assign are measured by their second group.
BASE = (("assign", ASSIGN, 6), ("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]{24,}", 24))
OTHER = r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}|-----BEGIN [A-Z ]*PRIVATE KEY-----"
KINDS = tuple(k for k, _, _ in BASE) + ("other",)
#: A value held by so many owners, or in so many repositories, is an example.
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 6
#: What a live value looks like: least length, least number of different characters, and words that it has not.
LIVE_LENGTH, LIVE_CHARACTERS = 8, 5
PLACEHOLDER = r"[eE][xX][aA][mM][pP][lL][eE]|[sS][aA][mM][pP][lL][eE]|[cC][hH][aA][nN][gG][eE]|[dD][uU][mM][mM][yY]|[yY][oO][uU][rR]|[xX]{4}|12345|abcde"


def _live(secret: Column) -> Column:
    different = F.size(F.array_distinct(F.split(secret, "")))
    return (F.length(secret) >= LIVE_LENGTH) & secret.rlike("[A-Za-z]") & secret.rlike("[0-9]") & (different >= LIVE_CHARACTERS) & ~secret.rlike(PLACEHOLDER)


def _found(rank: int, pattern: str, least: int) -> Column:
    """The matches of a pattern in column `t` in order: rank, gap before it, n characters, does it count, value_hash, live."""
    def match(gap: Column, value: Column) -> Column:
        secret = F.regexp_extract(value, ASSIGN, 2) if rank == 0 else value
        return F.struct(
            F.lit(rank).alias("rank"), F.length(gap).alias("gap"), F.length(value).alias("n"), (F.length(secret) >= least).alias("counts"),
            F.sha2(secret, 256).alias("value_hash"), _live(secret).alias("live"),
        )

    p = F.lit(pattern)
    values = F.regexp_extract_all("t", p, F.lit(0))
    # A text has one more gap than matches.
    matches = F.zip_with(F.slice(F.split("t", pattern, -1), F.lit(1), F.size(values)), values, match)
    return F.when(F.col("t").rlike(pattern), matches)


def ownership(candidates: DataFrame) -> DataFrame:
    """candidates(value_hash, owner, repository) -> value_hash, n_owners, n_repositories, and n_held, how many there are."""
    each = candidates.groupBy("value_hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = each.groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("value_hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repositories").alias("n_repositories"), F.sum("n").alias("n_held"))


def spans(docs: DataFrame, owner: Column, repository: Column, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> tuple[DataFrame, DataFrame]:
    """Two tables: row, doc_id of each row of docs, and row, rank, start, end, n_owners, n_repositories, example, live of each span."""
    none = F.array().cast("array<struct<rank:int,gap:int,n:int,counts:boolean,value_hash:string,live:boolean>>")
    given = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), F.coalesce(owner, F.lit("")).alias("owner"), F.coalesce(repository, F.lit("")).alias("repository"))
    kinds = [*((p, n) for _, p, n in BASE), (OTHER, 1)]
    found = F.concat(*[F.coalesce(_found(rank, p, n), none) for rank, (p, n) in enumerate(kinds)])
    rows = saved(given.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository", found.alias("found")), "secret-found")
    each = rows.where(F.size("found") > 0).select("row", "owner", "repository", F.posexplode("found").alias("at", "x")).select("row", "owner", "repository", "at", "x.*")
    so_far = W.partitionBy("row", "rank").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(so_far).cast("int")).withColumn("start", F.col("end") - F.col("n"))
    placed = saved(placed.where("counts").select("row", "owner", "repository", "rank", "start", "end", "value_hash", "live"), "secret-spans")
    told = join_hot(placed, saved(ownership(placed), "secret-owners"), "value_hash", "n_held")
    example = (F.col("n_owners") >= example_owners) | (F.col("n_repositories") >= example_repositories)
    told = told.withColumn("example", example).withColumn("live", ~example & (F.col("n_owners") == 1) & F.col("live"))
    return rows.select("row", "doc_id"), told.select("row", "rank", "start", "end", "n_owners", "n_repositories", "example", "live")


def scan(docs: DataFrame, owner: Column, repository: Column, **how) -> DataFrame:
    """docs(doc_id, text) -> doc_id, counts of the base kinds, base_sha256, spans, holders, n_live, n_example; a row per document.

    holders: for each span that is told, owners/repositories that hold its value; n_live and n_example count all spans.
    """
    rows, found = spans(docs, owner, repository, **how)
    base = F.col("rank") < len(BASE)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("rank") + 1)
    place = F.concat_ws(":", kind, F.col("start").cast("string"), F.col("end").cast("string"))
    held = F.concat_ws("/", F.col("n_owners").cast("string"), F.col("n_repositories").cast("string"))
    told = F.struct("start", "rank", place.alias("place"), held.alias("held"))
    per = found.groupBy("row").agg(
        *[F.count_if(F.col("rank") == r).alias(f"n_{k}") for r, (k, _, _) in enumerate(BASE)],
        F.sort_array(F.collect_list(F.when(base, told))).alias("base"), F.sort_array(F.collect_list(F.when(base | ~F.col("example"), told))).alias("told"),
        F.count_if("live").alias("n_live"), F.count_if("example").alias("n_example"),
    )
    out = rows.join(per, "row", "left")
    text = lambda c, f: F.coalesce(F.array_join(F.transform(c, lambda x: x[f]), ","), F.lit(""))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(
        "doc_id", *[zero(f"n_{k}") for k, _, _ in BASE], F.sha2(text("base", "place"), 256).alias("base_sha256"), text("told", "place").alias("spans"), text("told", "held").alias("holders"),
        zero("n_live"), zero("n_example"),
    )
