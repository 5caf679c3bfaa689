"""Secret scan with corpus-wide ownership frequency, in built-in functions only.

Candidates are found in every whole text: assignments, access keys and hex runs
(the base kinds) and mixed-case tokens of high variety. Each candidate's value
is hashed and counted over the corpus by distinct owners and repositories. A
value that several owners or many repositories hold is a widely copied example;
one that keeps to few of both and does not look like a placeholder is
live-looking, and its exact place is added as a ``live`` span. Base spans stay
whatever the verdict.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronolith.llm.common import Staging, join_groups, text_of


class Kind(NamedTuple):
    name: str
    pattern: str
    #: group that holds the value; it ends where the match ends
    group: int
    least: int


ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A maximal run of a class is matched whole, so the least length can stand in
#: the pattern of the kinds below; an assignment that is too short must still
#: use up its text, so its length is tested afterwards.
BASE = (Kind("assign", ASSIGN, 2, 12), Kind("access", r"AKIA[A-Z0-9]{14,}", 0, 18), Kind("hex", r"[0-9a-f]{16,}", 0, 16))
MIXED = Kind("mixed", r"[A-Za-z0-9+/_=-]{20,}", 0, 20)
LIVE = "live"
#: Values with one of these (lower case) are placeholders.
PLACEHOLDERS = ("example", "changeme", "placeholder", "dummy", "sample", "xxxx", "your", "0000000", "1234567", "abcdefg")
#: Distinct owners from which on a value counts as a widely copied example.
EXAMPLE_OWNERS = 3
#: Distinct repositories from which on it does so, whoever owns them.
EXAMPLE_REPOS = 6
#: Distinct characters that a live-looking value has at least.
LEAST_VARIETY = 8

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _spans(text: Column, kind: Kind, rank: int) -> Column:
    """Matches of a kind with their code-point ranges, in order.

    The pieces between matches and the matches themselves add up to the text,
    which gives every match its place.
    """
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else hits
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda x: F.length(x))
    parts = F.slice(F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value")), 1, F.size(hits))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.length(x["value"]) >= kind.least, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    empty = F.array().cast(_SPAN)
    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda acc: acc["found"])
    return F.when(text.rlike(kind.pattern), found).otherwise(empty)


def _live_looking(value: Column) -> Column:
    low = F.lower(value)
    placeholder = F.lit(False)
    for word in PLACEHOLDERS:
        placeholder = placeholder | F.contains(low, F.lit(word))
    return ~placeholder & (F.size(F.array_distinct(F.split(value, ""))) >= LEAST_VARIETY)


def _render(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_cols: tuple[str, ...] = ("source",), repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """A row for each document: row__, doc_id, owner, repo, base and mixed spans.

    ``row__`` tells rows apart that repeat an id. Owner and repository are the
    given columns as one string; a missing or null one is empty.
    """
    def joined(columns: tuple[str, ...]) -> Column:
        return F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("") for c in columns])

    text = F.col("text__")
    rows = docs.select(F.monotonically_increasing_id().alias("row__"), F.col(id_col).alias("doc_id"), joined(owner_cols).alias("owner"), joined(repo_cols).alias("repo"), text_of(text_col).alias("text__"))
    mixed = F.filter(_spans(text, MIXED, len(BASE)), lambda s: s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]") & s["value"].rlike("[0-9]"))
    return rows.select("row__", "doc_id", "owner", "repo", F.concat(*[_spans(text, k, i) for i, k in enumerate(BASE)]).alias("base"), mixed.alias("mixed"))


def ownership(found: DataFrame) -> DataFrame:
    """Each candidate value's hash with its distinct owners and repositories.

    Counted level by level, so every level is pre-aggregated before a shuffle
    and a value that a third of all rows hold is no large group. Null owners and
    repositories count as empty ones; candidates that repeat count as places; no
    candidates give an empty result.
    """
    values = found.filter((F.size("base") > 0) | (F.size("mixed") > 0)).select("owner", "repo", F.explode(F.concat("base", "mixed")).alias("s"))
    hashed = values.select(F.sha2(F.encode(F.col("s.value"), "UTF-8"), 256).alias("value_sha256"), "owner", "repo", _live_looking(F.col("s.value")).alias("looks_live"))
    by_repo = hashed.groupBy("value_sha256", "owner", "repo").agg(F.count(F.lit(1)).alias("n"), F.max("looks_live").alias("looks_live"))
    by_owner = by_repo.groupBy("value_sha256", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"), F.max("looks_live").alias("looks_live"))
    return by_owner.groupBy("value_sha256").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_places"), F.max("looks_live").alias("looks_live"))


def scan(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, **columns) -> DataFrame:
    """Secrets of every document, with spans and the verdict on their values.

    Returns doc_id, base (spans of the base kinds), live (spans of values that
    keep to fewer than ``example_owners`` owners and ``example_repos``
    repositories and look live), n_example (candidates whose value is a widely
    copied example). Null and empty texts have no spans; a row that repeats an
    id has a result of its own; an empty table gives an empty result; other
    columns are ignored.
    """
    with Staging() as own:
        found = own.keep(own.stage(candidates(docs, **columns), "secret-candidates"))
        counts = own.stage(ownership(found), "secret-ownership")
        places = found.filter((F.size("base") > 0) | (F.size("mixed") > 0)).select("row__", F.explode(F.concat("base", "mixed")).alias("s"))
        places = places.withColumn("value_sha256", F.sha2(F.encode(F.col("s.value"), "UTF-8"), 256))
        live = F.struct((F.col("s.end") - F.length("s.value")).alias("start"), F.lit(len(BASE)).alias("rank"), F.col("s.end").alias("end"), F.lit(LIVE).alias("kind"), F.col("s.value").alias("value"))
        is_example = (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos)
        judged = own.keep(own.stage(join_groups(places, counts, "value_sha256", "n_places").groupBy(F.col("row__").alias("of__")).agg(
            F.array_distinct(F.collect_list(F.when(~is_example & F.col("looks_live"), live))).alias("live"), F.count_if(is_example).alias("n_example")
        ), "secret-judged"))
    return found.join(judged, F.col("row__") == F.col("of__"), "left").select(
        "doc_id", "base", F.coalesce("live", F.array().cast(_SPAN)).alias("live"), F.coalesce("n_example", F.lit(0)).alias("n_example")
    )


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and rendered spans of :func:`scan`'s rows."""
    def count(name: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == name)).cast("long")

    return scanned.select(
        "doc_id", *[count(k.name).alias(f"n_{k.name}") for k in BASE], F.sha2(F.encode(_render(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
        _render(F.concat("base", "live")).alias("spans"), F.size("live").cast("long").alias("n_live"), F.col("n_example").cast("long").alias("n_example"),
    )
