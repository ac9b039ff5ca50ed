"""Secret scans with corpus-wide ownership frequency, on DataFrame functions only.

Base candidates are found by three patterns; further candidates by the published formats of access tokens and by
long strings that mix upper case, lower case and digits. All candidates' hashes are counted over the corpus by
distinct repository and distinct owner: a value that more than ``OWNERS`` owners or more than ``REPOSITORIES``
repositories share is a widely copied example, any other is taken for a live credential of its owners. With
``copies_once`` the verdict takes all rows of one text for one owner and one repository (their smallest), so that a secret
does not turn into an example because its document was copied; the owners and repositories of all rows, copies among them,
are counted and reported all the same. All spans are reported, each with its verdict and counts.

Defined results: a null text counts as empty; a null owner or repository counts as one unknown; repeated rows are
rows of their own (``row`` tells them apart); an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .common import unused

# The base patterns, each with the group that holds the secret and its least length.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
    "access": (r"(AKIA[A-Z0-9]+)", 18),
    # A run of at least 16 is the longest run of 16 or more: nothing shorter has to be matched and dropped.
    "hex": (r"([0-9a-f]{16,})", 16),
}
# Published token formats, and mixed strings.
MORE = {
    "token": (r"(gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}"
              r"|xox[abeoprs]-[A-Za-z0-9-]{10,}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}"
              r"|eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+)", 1),
    "mixed": (r"([A-Za-z0-9+/_=-]{24,})", 24),
}
# What a mixed string must hold.
MIXED = ("[0-9]", "[A-Z]", "[a-z]")
KINDS = (*BASE, *MORE)
OWNERS, REPOSITORIES = 2, 20
MASK = "[SECRET]"


def _spans(text: Column, kind: str, pattern: str, least: int) -> Column:
    """Spans of one kind in code points, end exclusive, with the secret part.

    Most texts have none, which a plain search shows soonest. In the others the pattern is tied to the end of the
    last match, so one walk gives the text before each match, the match and its secret part in turn; their
    lengths give the positions.
    """
    tied = rf"\G((?s:.)*?)({pattern})"
    gaps, hits, values = (F.regexp_extract_all(text, F.lit(tied), F.lit(group)) for group in (1, 2, 3))
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")

    def step(seen: Column, found: Column) -> Column:
        first = seen["at"] + F.length(found["gap"])
        last = first + F.length(found["hit"])
        value = found["value"]
        span = F.struct(F.lit(KINDS.index(kind)).alias("kind"), first.alias("start"), last.alias("end"), value.alias("value"))
        kept = F.length(value) >= least
        for part in MIXED if kind == "mixed" else ():
            kept = kept & value.rlike(part)
        return F.struct(last.alias("at"), F.when(kept, F.array_append(seen["out"], span)).otherwise(seen["out"]).alias("out"))

    pieces = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    found = F.aggregate(pieces, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda seen: seen["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def _all_spans(text: Column) -> Column:
    return F.concat(*[_spans(text, kind, pattern, least) for kind, (pattern, least) in {**BASE, **MORE}.items()])


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
               repository_col: str = "doc_id") -> DataFrame:
    """A row per text: ``row``, ``key`` (the id), owner, repository and all spans with the hash of the secret part.

    Written once, without the text: everything later reads this narrow table.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = F.transform(_all_spans(text), lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")))
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("key"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository_col).cast("string"), F.lit("")).alias("repository"),
        F.sort_array(spans).alias("spans"), F.sha2(text, 256).alias("same"))
    return stage(found, "secrets")


def _frequency(seen: DataFrame, prefix: str) -> DataFrame:
    return seen.groupBy("hash").agg(F.countDistinct("repository").alias(f"{prefix}_repositories"),
                                    F.countDistinct("owner").alias(f"{prefix}_owners"))


def ownership(found: DataFrame, copies_once: bool = False) -> DataFrame:
    """Per hash: ``n_repositories`` and ``n_owners``, which decide whether it is ``live``, and ``all_repositories`` and
    ``all_owners``, those of every row that holds it. A row per hash, written once."""
    seen = found.select("owner", "repository", "same", F.explode("spans").alias("s")).select(
        F.col("s.hash").alias("hash"), "same", "owner", "repository")
    if copies_once:
        seen = stage(seen.distinct(), "secret-seen")
        once = seen.groupBy("hash", "same").agg(F.min("owner").alias("owner"), F.min("repository").alias("repository"))
        counted = _frequency(once, "n").join(_frequency(seen, "all"), "hash")
    else:
        counted = _frequency(seen, "n").withColumns({"all_repositories": F.col("n_repositories"), "all_owners": F.col("n_owners")})
    return stage(counted.withColumn(
        "live", (F.col("n_owners") <= OWNERS) & (F.col("n_repositories") <= REPOSITORIES)), "secret-owners")


def judged_spans(found: DataFrame, owners: DataFrame) -> DataFrame:
    """A row per span: ``row``, ``key``, ``start``, ``kind``, ``end`` and the counts and verdict of its hash."""
    each = found.filter(F.size("spans") > 0).select("row", "key", F.explode("spans").alias("s")).select("row", "key", "s.*")
    return stage(each, "secret-spans").join(owners, "hash")


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repository_col: str = "doc_id", copies_once: bool = False) -> DataFrame:
    """Per row: the id, ``base`` spans (start, kind, end) in order, counts by base kind, and all ``judged`` spans in
    order, with ``live`` and the counts of their hash (see ``ownership``)."""
    found = candidates(docs, id_col, text_col, owner_col, repository_col)
    own = len(BASE)
    each = F.struct("start", "kind", "end", "live", "n_owners", "n_repositories", "all_owners", "all_repositories")
    judged = (judged_spans(found, ownership(found, copies_once))
              .groupBy("row").agg(F.sort_array(F.collect_list(each)).alias("judged")))
    plain = F.transform(F.filter("spans", lambda s: s["kind"] < own),
                        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    base = found.select("row", F.col("key").alias(id_col), plain.alias("base"), *[
        _count("spans", kind).alias(f"n_{KINDS[kind]}") for kind in range(own)])
    none = F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean,n_owners:bigint,n_repositories:bigint,"
                             "all_owners:bigint,all_repositories:bigint>>")
    return base.join(judged, "row", "left").withColumn("judged", F.coalesce("judged", none)).drop("row")


def digests(scanned: DataFrame) -> DataFrame:
    """The base spans' checksum, all spans as text, and in the same order ``verdicts``: live or example, with the numbers of
    owners and repositories that decided it, and ``ownership``: the numbers of owners and repositories of all rows."""
    own = len(BASE)
    verdicts = F.transform("judged", lambda s: F.concat_ws(
        ":", F.when(s["live"], "live").otherwise("example"), s["n_owners"].cast("string"), s["n_repositories"].cast("string")))
    everyone = F.transform("judged", lambda s: F.concat_ws(":", s["all_owners"].cast("string"), s["all_repositories"].cast("string")))
    rest = [c for c in scanned.columns if c not in ("base", "judged")]
    return scanned.select(*rest, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                          _joined(F.col("judged")).alias("spans"), F.array_join(verdicts, ",").alias("verdicts"), F.array_join(everyone, ",").alias("ownership"),
                          F.size(F.filter("judged", lambda s: s["live"] & (s["kind"] < own))).cast("long").alias("n_live_base"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
           size_col: str | None = "n_chars", copies_once: bool = False) -> DataFrame:
    """``docs`` with every live secret in a text replaced by ``MASK`` and its size column brought up to date.

    Widely copied examples stay. Rows are matched by id; rows that share an id are each cleared of all live
    secrets of that id. Rows with a null id are cleared of every base secret.
    """
    found = candidates(docs, id_col, text_col, owner_col, id_col)
    hashes, key = unused(docs, "live"), unused(docs, "key")
    live = (judged_spans(found, ownership(found, copies_once)).filter(F.col("live") & F.col("key").isNotNull())
            .groupBy(F.col("key").alias(key)).agg(F.collect_set("hash").alias(hashes)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    values = F.transform(_all_spans(text), lambda s: s["value"])
    chosen = F.filter(values, lambda v: F.col(hashes).isNull() | F.array_contains(F.col(hashes), F.sha2(v, 256)))
    # Longest first, so that a secret inside another does not break it up.
    longest = F.reverse(F.sort_array(F.transform(F.array_distinct(chosen), lambda v: F.struct(F.length(v).alias("n"), v.alias("v")))))
    masked = F.aggregate(longest, text, lambda t, s: F.replace(t, s["v"], F.lit(MASK)))
    # The list of documents with secrets grows with the corpus, so it is joined alike at every size, never broadcast.
    live = stage(live, "secret-live").hint("merge")
    matched = docs.join(live, F.col(id_col) == F.col(key), "left")
    touched = F.col(hashes).isNotNull() | F.col(id_col).isNull()
    out = []
    for name in docs.columns:
        if name == text_col:
            out.append(F.when(touched & F.col(text_col).isNotNull(), masked).otherwise(F.col(text_col)).alias(name))
        elif size_col is not None and name == size_col:
            kind = docs.schema[name].dataType
            out.append(F.when(touched & F.col(text_col).isNotNull(), F.length(masked)).otherwise(F.col(name)).cast(kind).alias(name))
        else:
            out.append(F.col(name))
    return matched.select(*out)
