"""Secrets in texts, and who owns them across the corpus, with SQL functions only.

Candidates of each kind are cut out by regular expressions; the lengths of what lies between them
give their places. Every candidate's value is hashed, and over the whole corpus the distinct
repositories and owners that hold a hash are counted: a value that many owners hold is an example
copied from elsewhere, one of a single owner with the randomness of a key looks live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.storage import cut

# Kind -> (pattern, group that is the value, characters the value must have at least); fixed values of the contract.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 18),
    "hex": (r"([0-9a-f]{16,})", 1, 16),  # the whole runs of 16 and more among all runs
}
ADDED = ("live", "example")
MAX_OWNERS = 2  # a live credential is held by so many owners at most
MIN_DISTINCT = 8  # and shows so many different characters at least
RUN = 128  # matches whose lengths are summed together


def _places(texts: DataFrame, kind: str) -> DataFrame:
    """``texts`` with a column of the kind's name: an array of (s, e, v) of its matches that are long enough.

    Places count code points, ends are exclusive. The lengths of the matches and of what lies between them are
    summed in runs of RUN matches and then over the runs, so that the work is in proportion to the matches.
    """
    pattern, group, least = KINDS[kind]
    lengths = lambda strings: F.transform(strings, lambda x: F.char_length(x))
    places = F.array().cast("array<struct<s:int,e:int>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + x["b"]
        end = start + x["w"]
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(F.struct(start.alias("s"), end.alias("e")))).alias("found"))

    def add_run(state: Column, run: Column) -> Column:
        return F.struct((state["at"] + run["at"]).alias("at"), F.concat(state["found"], F.array(state["at"])).alias("found"))

    def moved(run: Column, by: Column) -> Column:
        return F.transform(run["found"], lambda x: F.struct((x["s"] + by).alias("s"), (x["e"] + by).alias("e")))

    # A step each, so that no expression is worked out twice.
    cut_out = texts.withColumn("_w", lengths(F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))).withColumn(
        "_v", F.regexp_extract_all("_text", F.lit(pattern), F.lit(group))).withColumn("_b", lengths(F.split("_text", pattern)))
    steps = cut_out.withColumn("_steps", F.zip_with(F.slice("_b", F.lit(1), F.size("_w")), "_w", lambda b, w: F.struct(b.alias("b"), w.alias("w"))))
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size("_steps") / RUN).cast("int")), lambda i: F.aggregate(
        F.slice("_steps", i * RUN + 1, F.lit(RUN)), F.struct(F.lit(0).alias("at"), places.alias("found")), add))
    before = F.aggregate("_runs", F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found")), add_run, lambda state: state["found"])
    whole = steps.withColumn("_runs", runs).withColumn("_places", F.flatten(F.zip_with("_runs", before, moved)))
    found = F.zip_with("_places", "_v", lambda x, v: F.struct(x["s"].alias("s"), x["e"].alias("e"), v.alias("v")))
    return whole.select(*texts.columns, F.filter(found, lambda x: F.char_length(x["v"]) >= least).alias(kind))


def _of_kind(kind: str) -> Column:
    place = list(KINDS).index(kind)
    return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(place).alias("i"), x["e"].alias("e"), F.lit(kind).alias("kind")))


def _joined(spans: Column) -> Column:
    """Spans as kind:start:end in order of start, then of kind."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def scan(docs: DataFrame, owner: str = "source", repository: tuple[str, ...] = ("source", "lang"), max_owners: int = MAX_OWNERS,
         id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example, max_owners, max_repositories.

    ``spans`` lists the spans of the three kinds and, of the values in them, those judged: "live" with at
    most ``max_owners`` distinct owners and MIN_DISTINCT different characters, "example" with more owners.
    The last two columns are the largest numbers of any value in the document, null without one. Null
    texts count as empty: no spans, and the checksum of the empty text. A null owner or repository counts
    as one of its own. Rows are kept one for one; other columns are ignored.
    """
    picked = docs.select(docs[id].cast("long").alias("doc_id"), F.coalesce(docs[owner].cast("string"), F.lit("")).alias("owner"),
                         F.xxhash64(*[F.coalesce(docs[c].cast("string"), F.lit("")) for c in repository]).alias("repository"),
                         F.coalesce(docs[text].cast("string"), F.lit("")).alias("_text"))
    for kind in KINDS:
        picked = _places(picked, kind)
    base = F.concat(*[_of_kind(k) for k in KINDS])
    values = F.concat(*[F.transform(k, lambda x: F.struct((x["e"] - F.char_length(x["v"])).alias("s"), x["e"].alias("e"), x["v"].alias("v"))) for k in KINDS])
    judged = F.transform(values, lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.sha2(x["v"], 256).alias("hash"),
        (F.size(F.array_remove(F.array_distinct(F.split(x["v"], "")), "")) >= MIN_DISTINCT).alias("random")))
    # One pass over the texts; everything after works on the few candidates. The key tells equal ids apart.
    rows = cut(picked.select("doc_id", "owner", "repository", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                             base.alias("base"), judged.alias("values"), F.monotonically_increasing_id().alias("key")))
    candidates = rows.where(F.size("values") > 0).select("key", "owner", "repository", F.inline("values"))
    # Distinct holders first, so that a value that a third of all rows hold is a few rows per task.
    holders = candidates.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
    owned = holders.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    spread = owned.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    known = candidates.join(spread, "hash")
    verdict = F.when(F.col("owners") > max_owners, "example").when(F.col("random"), "live")
    place = F.when(F.col("owners") > max_owners, len(KINDS) + 1).otherwise(len(KINDS))
    added = known.groupBy("key").agg(
        F.collect_set(F.when(verdict.isNotNull(), F.struct("s", place.alias("i"), "e", verdict.alias("kind")))).alias("added"),
        F.max("owners").alias("max_owners"), F.max("repositories").alias("max_repositories"))
    none = F.array().cast("array<struct<s:int,i:int,e:int,kind:string>>")
    whole = rows.join(added, "key", "left").withColumn("added", F.coalesce("added", none))
    count = lambda kind: F.size(F.filter("added", lambda x: x["kind"] == kind)).cast("long")
    return whole.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", "added")).alias("spans"), *[count(k).alias(f"n_{k}") for k in ADDED],
                        "max_owners", "max_repositories")
