"""Secrets in texts, told from widely copied examples by who owns them (operator 11), in DataFrame expressions only.

Method: ownership frequency over the whole corpus. Three patterns find base spans: assignments to a secret's
name, access key ids and long hexadecimal runs; a fourth finds long opaque tokens. Each value they find is a candidate,
known by a digest. Candidates are aggregated by the repositories and owners they stand in. A value in several
owners' hands, or in very many repositories, is a widely copied example. A value that few hold and that looks live
(long enough, letters and digits, many different characters, no word of a placeholder) is a credential of
its owner, and each place where it stands is a span of kind ``live``, in texts where no base pattern shows it too.
Base spans stay whatever becomes of their values.

A repository is a document of an owner, an owner a source; both are parameters. Distinct pairs are counted
level by level (value, owner and repository; value and owner; value), each with partial sums, so a value that a
third of all rows hold is not gathered anywhere, and it meets its places in a join that Spark can split.
Positions come from running sums over the pieces of one text.

Defined cases: a null text is empty. A document without spans has the digest of the empty text. Rows that repeat id and
text are one document of their owner and all get its spans; a null id is an id, a null owner an owner. A null repository
counts as one of its owner. Positions are code points, ends are exclusive. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.keys import marked
from rollcall.storage import land

#: Kinds in their order; the first three are the base.
KINDS = ("assign", "access", "hex", "token", "live")
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs that are too short fail as a whole, so the shortest length can stand in the pattern. Not so the value of an assignment.
PATTERNS = (ASSIGN, "AKIA[A-Z0-9]{12,}", "[0-9a-f]{32,}", "[A-Za-z0-9+/_-]{20,}")
LEAST_VALUE = 8
#: From so many owners, or beyond so many repositories, a value is widely copied.
COPIED_OWNERS, MOST_REPOSITORIES = 3, 100
LIVE_LENGTH, LIVE_DISTINCT = 16, 8
PLACEHOLDER = "(?i)example|sample|dummy|changeme|placeholder|your_?|test|x{4}|1234567"
#: Set around matches; a text that holds it gets another character there that no pattern knows either.
_EDGE, _OTHER = "\x01", "\x02"


def looks_live(value: Column) -> Column:
    """Whether a value could be a credential: long, mixed, varied, and not a placeholder."""
    varied = F.size(F.array_distinct(F.split(F.substring(value, 1, 64), ""))) >= LIVE_DISTINCT
    return (F.length(value) >= LIVE_LENGTH) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & varied & ~value.rlike(PLACEHOLDER)


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut at both ends of each match: pieces with an odd number are matches."""
    return F.split(F.regexp_replace(F.translate(text, _EDGE, _OTHER), F.lit(pattern), F.lit(f"{_EDGE}$0{_EDGE}")), _EDGE, -1)


def candidates(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, text_mark, owner, repository, kind (number in ``KINDS``), start, end and value_start, digest, looks_live of all matches."""
    rows = marked(docs, F.col(f"`{owner}`").cast("string").alias("owner"), F.col(f"`{repository}`").cast("string").alias("repository"))
    cut = rows.select("doc_id", "text_mark", "owner", "repository", *(_pieces(F.col("text"), p).alias(f"k{k}") for k, p in enumerate(PATTERNS)))

    def described(kind: int) -> Column:
        def piece(text: Column, place: Column) -> Column:
            value = F.regexp_extract(text, ASSIGN, 1) if kind == 0 else text
            is_match = place % 2 == 1
            known = F.when(is_match, F.struct(F.length(value).alias("size"), F.unhex(F.sha2(value, 256)).alias("digest"), looks_live(value).alias("looks_live")))
            return F.struct(F.lit(kind).alias("kind"), place.alias("place"), F.length(text).cast("long").alias("length"), known.alias("value"))

        name = f"k{kind}"
        return F.when(F.size(name) > 1, F.transform(name, piece)).otherwise(F.array())

    found = cut.select("doc_id", "text_mark", "owner", "repository", F.explode(F.concat(*(described(k) for k in range(len(PATTERNS))))).alias("p"))
    found = found.select("doc_id", "text_mark", "owner", "repository", "p.*")
    # A document that stands in several rows, or with several owners, is cut once for each owner.
    found = found.dropDuplicates(["doc_id", "text_mark", "owner", "repository", "kind", "place"])
    upto = F.sum("length").over(Window.partitionBy("doc_id", "text_mark", "owner", "repository", "kind").orderBy("place"))
    found = found.withColumn("end", upto).filter(F.col("value").isNotNull())
    start, value_start = F.col("end") - F.col("length"), F.col("end") - F.col("value.size")
    found = found.select("doc_id", "text_mark", "owner", "repository", "kind", start.alias("start"), "end", value_start.alias("value_start"), "value.digest", "value.looks_live")
    return found.filter((F.col("kind") != 0) | (F.col("end") - F.col("value_start") >= LEAST_VALUE))


def ownership(found: DataFrame) -> DataFrame:
    """digest, owners, repositories, looks_live and ``standing`` (live, copied or weak) of every value."""
    pairs = found.groupBy("digest", "owner", "repository").agg(F.max("looks_live").alias("looks_live"))
    held = pairs.groupBy("digest", "owner").agg(F.count("*").alias("repositories"), F.max("looks_live").alias("looks_live"))
    held = held.groupBy("digest").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("looks_live").alias("looks_live"))
    copied = (F.col("owners") >= COPIED_OWNERS) | (F.col("repositories") > MOST_REPOSITORIES)
    return held.withColumn("standing", F.when(copied, F.lit("copied")).when(F.col("looks_live"), F.lit("live")).otherwise(F.lit("weak")))


def secrets(docs: DataFrame, repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, text_mark and ``spans`` (sorted structs start, kind, end, standing) of every document with a candidate.

    Kinds are numbers of ``KINDS``. Opaque tokens are not spans unless they are live.
    """
    found = land(candidates(docs, repository, owner), "candidates")
    # Read back, the standings are dealt out for the join itself, which only then can be split.
    known = found.join(land(ownership(found), "ownership").select("digest", "standing"), "digest")
    base = F.when(F.col("kind") < 3, F.struct("start", "kind", "end", "standing"))
    live = F.when(F.col("standing") == "live", F.struct(F.col("value_start").alias("start"), F.lit(KINDS.index("live")).alias("kind"), "end", "standing"))
    spans = known.select("doc_id", "text_mark", F.explode(F.array(base, live)).alias("span")).filter("span IS NOT NULL")
    return spans.groupBy("doc_id", "text_mark").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_secret_scans(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, all spans, live and copied values' places."""
    rows = marked(docs.select("doc_id", "text", "source")).select("doc_id", "text_mark")
    found = land(secrets(docs), "secrets").withColumnsRenamed({"doc_id": "of_id", "text_mark": "of_mark"})
    rows = rows.join(found, rows["doc_id"].eqNullSafe(found["of_id"]) & (rows["text_mark"] == found["of_mark"]), "left")
    rows = rows.select("doc_id", F.coalesce("spans", F.array().cast(dict(found.dtypes)["spans"])).alias("spans"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda kind: count(lambda s: s["kind"] == kind).alias(f"n_{KINDS[kind]}")
    return rows.select(
        "doc_id", *map(of_kind, range(3)), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        of_kind(KINDS.index("live")), count(lambda s: (s["kind"] < 3) & (s["standing"] == "copied")).alias("n_copied"),
    )
