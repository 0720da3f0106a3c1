"""Personal data: generators propose spans, boosted trees choose among them.

Base spans (e-mail addresses, IP addresses, card and phone numbers) come from
fixed patterns with checks and always stay.  Generators of high recall propose
further, overlapping spans: the base patterns without their checks, disguised
addresses, short forms, phone numbers without a plus sign, other digit groups.
Gradient-boosted trees score every proposal by format and context, with its
disguise undone, so that a hidden value looks like a plain one.  There are no
labels; weak ones stand in: a proposal is positive if it is a base span, if its
value stands elsewhere as a base span, or if it passes the check of its kind
and something speaks for it (a known ending, an issuer's prefix, a word right
before).  Labels only train and calibrate.  What is added is decided by the
score alone: a kind's threshold is the lowest score from which on held-out
proposals are positive with the wanted precision, as a confidence bound over
all of them and as it stands among those that may be added.

Everything runs as DataFrame expressions and Spark ML.  All counted quantities
of the patterns are possessive or start only where a run of their characters
starts, so long texts are scanned in linear time.
"""

from __future__ import annotations

from math import sqrt

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from raremine.llm.store import if_small, written

KINDS = ("email", "ip", "card", "phone")
#: About so many rows the trees are fitted on; thresholds cover all held-out rows.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 4, 17
#: Held-out precision that a threshold promises, as the lower end of a confidence
#: interval (normal quantile Z): few rows make it stricter, none is needed.
PRECISION, Z = 0.95, 1.64
CONTEXT = 24

# Base patterns; \G lets a match start right after the one before it.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character without which a text cannot match.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: Further proposals: (kind, pattern).
LOOSE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s?[\[(]\s?(?:at|@)\s?[\])]\s?[A-Za-z0-9-]++"
              r"(?:(?:\s?[\[(]\s?dot\s?[\])]\s?|\.)[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])"),
    ("ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}+:){1,6}+(?::[0-9A-Fa-f]{1,4}+){1,6}+(?![0-9A-Za-z:])"),
    ("ip", r"(?<![0-9.])(?:[0-9]{1,3}+\[\.\]){3}+[0-9]{1,3}+(?![0-9])"),
    ("card", r"(?<![0-9A-Za-z])[0-9]{4}[\x20-]?[0-9]{4,6}[\x20-]?[0-9]{4,5}(?:[\x20-]?[0-9]{1,4}){0,2}+(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z])\(?[0-9]{2,4}+\)?[\x20./-]{1,2}+[0-9]{2,4}+[\x20./-][0-9]{2,5}+(?:[\x20./-][0-9]{2,5}+)*+(?![0-9A-Za-z])"),
    ("phone", r"(?<![0-9A-Za-z.,+-])[0-9]{8,15}+(?![0-9A-Za-z])"),
)
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
KEYWORDS = {
    "email": "mail|contact|write|address", "ip": r"\bip\b|host|server|address|login",
    "card": "card|visa|master|amex|credit|payment|karte|carte|tarjeta", "phone": r"tel|phone|call|mobile|fax|handy|num"}

# Disguises, and what takes their place before a proposal is checked.
DISGUISES = ((r"(?i)\s?[\[(]\s?(?:at|@)\s?[\])]\s?", "@"), (r"(?i)\s?[\[(]\s?(?:dot|\.)\s?[\])]\s?", "."))
EMAIL = r"\A[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z][A-Za-z0-9-]*\z"
#: Endings of addresses whose dots are plain ("look (at) this.thing" is none); after a written-out dot any word will do.
ENDINGS = (r"(?i)\.(?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|pro|dev|app|xyz|online|site|shop|store|tech|cloud|blog|email|"
           r"museum|coop|aero|jobs|mobi|travel|example|test|invalid)\z")
WRITTEN_DOT = r"(?i)[\[(]\s?dot\s?[\])]\s?[a-z]{2,}\z"
#: Eight groups, or fewer with one run of zero groups left out.
IPV6 = r"\A(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?=(?:[0-9A-Fa-f]+:+){1,6}[0-9A-Fa-f]+\z)(?:[0-9A-Fa-f]{1,4}:)+(?::[0-9A-Fa-f]{1,4})+)\z"
DATE = (r"\A\(?(?:(?:19|20)[0-9]{2}[\x20./-]+[01]?[0-9][\x20./-][0-3]?[0-9](?![0-9])|"
        r"[0-3]?[0-9][\x20./-]+[0-3]?[0-9][\x20./-](?:19|20)[0-9]{2}(?![0-9]))")
#: Prefixes and lengths of card issuers.
ISSUER = (r"\A(?:4[0-9]{15}|4[0-9]{18}|3[47][0-9]{13}|3(?:0[0-5]|[689][0-9])[0-9]{11}|(?:5[1-5]|2[2-7])[0-9]{14}|"
          r"(?:6[0-9]|35)[0-9]{14,17})\z")
#: Right before a phone number, with nothing between that names another thing.
PHONE_WORD = (r"(?<![a-z])(?:tel|tele?phone|telefon|phone|call|mobile|cell|cellphone|fax|handy|whatsapp)(?![a-z])"
              r"(?:[^0-9a-z]|(?<![a-z])(?:number|no|nr|us|me|him|her|them|at|on|is|or|the|our|my|office|line|direct)(?![a-z])){0,12}\z")


def _matches(text: Column, pattern: str, needs: str | None = None) -> Column:
    """array<struct<start, end, value>> of all matches, leftmost and without
    overlap; positions in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if needs:
        found = F.when(F.contains(text, F.lit(needs)), found).otherwise(F.array().cast("array<string>"))
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(F.length(b).alias("gap"), m.alias("value")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.array_append(
            acc["out"], F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(pairs, begin, step)["out"]).otherwise(begin["out"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True if the digit string passes the Luhn check."""
    def value(i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.rlike(value, F.lit(rf"\A(?:{IP_PART}\.){{3}}{IP_PART}\z"))
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def _checked(matches: Column, kind: str) -> Column:
    return F.filter(matches, lambda m: _valid(kind, m["value"]))


def _ranked(matches: Column, rank: int) -> Column:
    return F.transform(matches, lambda m: F.struct(F.lit(rank).alias("rank"), m["start"].alias("start"), m["end"].alias("end")))


def _proposed(matches: Column, rank: int, generator: int, body: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(
        F.lit(rank).alias("rank"), F.lit(generator).alias("generator"), m["start"].alias("start"), m["end"].alias("end"),
        m["value"].alias("value"),
        F.substr(body, F.greatest(m["start"] - CONTEXT, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT))).alias("before"),
        F.substr(body, m["end"] + 1, F.lit(CONTEXT)).alias("after")))


def find_base(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_key, base, proposals) per row: base spans as
    array<struct<rank, start, end>> in order, proposals with context."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_key"), body.alias("body"))
    body = F.col("body")
    for kind in KINDS:
        rows = rows.withColumn(f"all_{kind}", _matches(body, BASE[kind], NEEDS[kind]))
    parts, proposals = [], []
    for rank, kind in enumerate(KINDS):
        every = F.col(f"all_{kind}")
        parts.append(_ranked(_checked(every, kind), rank))
        # short digit runs are no cards; the rest of what a pattern found is proposed, checks or not
        wide = F.filter(every, lambda m: F.length(m["value"]) >= 12) if kind == "card" else every
        proposals.append(_proposed(wide, rank, 0, body))
    for generator, (kind, pattern) in enumerate(LOOSE, 1):
        proposals.append(_proposed(_matches(body, pattern), KINDS.index(kind), generator, body))
    every = F.concat(*proposals)
    return rows.select("key", "text_key", F.concat(*parts).alias("base"), every.alias("proposals"))


# ------------------------------------------------------------------ scoring --

#: What the trees see: format of the proposal with its disguise undone and its
#: plus sign gone (so that base spans and disguised ones look alike), and context.
FEATURES = ("rank", "length", "n_digits", "n_separators", "n_groups", "longest_group", "letters", "joined_before", "joined_after",
            "keyword", "right_before", "quoted", "hex_near", "other_name", "valid", "ending", "issuer")
#: Words before numbers of other things.
OTHER_NAMES = r"(?<![a-z])(?:order|invoice|ref|reference|isbn|issn|version|sku|ticket|case|serial|account|part|item|page|id)(?![a-z])"


def _plain(value: Column) -> Column:
    for pattern, instead in DISGUISES:
        value = F.regexp_replace(value, pattern, instead)
    return F.regexp_replace(value, r"\A\+", "")


def _of_kind(by_kind) -> Column:
    out = None
    for rank, kind in enumerate(KINDS):
        out = F.when(F.col("rank") == rank, by_kind[kind]) if out is None else out.when(F.col("rank") == rank, by_kind[kind])
    return out


def _checks(p: DataFrame) -> DataFrame:
    """``plain``; ``valid``: it passes the check of its kind; ``ending``,
    ``issuer``, ``right_before``: what speaks for it besides."""
    v, before, after = F.col("value"), F.col("before"), F.col("after")
    p = p.withColumn("plain", _plain(v))
    plain, digits = F.col("plain"), _digits(v)
    is_ip = _valid("ip", plain)
    valid = {
        "email": F.rlike(plain, F.lit(EMAIL)),
        # groups of two characters throughout are hardware addresses
        "ip": is_ip | (F.rlike(v, F.lit(IPV6)) & (F.rlike(v, F.lit("[0-9A-Fa-f]{3}")) | F.contains(v, F.lit("::")))),
        "card": F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False),
        "phone": F.length(digits).between(8, 15) & ~is_ip & ~F.rlike(v, F.lit(DATE))}
    named = {"email": F.lit(False), "ip": F.lit(False), "card": F.rlike(F.lower(before), F.lit(KEYWORDS["card"])),
             "phone": F.rlike(F.lower(before), F.lit(PHONE_WORD)) & ~F.rlike(after, F.lit(r"\A[0-9A-Za-z_]"))}
    return (p.withColumn("valid", _of_kind(valid)).withColumn("right_before", _of_kind(named))
            .withColumn("ending", (F.col("rank") == 0) & (F.rlike(plain, F.lit(ENDINGS)) | F.rlike(v, F.lit(WRITTEN_DOT))))
            .withColumn("issuer", (F.col("rank") == 2) & F.rlike(digits, F.lit(ISSUER))))


def _features(p: DataFrame) -> DataFrame:
    """Format and context of proposals as numeric columns."""
    v, before, after = F.col("plain"), F.col("before"), F.col("after")
    digits = _digits(v)
    groups = F.filter(F.split(v, "[^0-9A-Za-z]+"), lambda g: g != "")
    values = {
        "length": F.length(v), "n_digits": F.length(digits), "n_separators": F.length(F.regexp_replace(v, "[0-9A-Za-z]", "")),
        "n_groups": F.size(groups), "longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "letters": F.length(F.regexp_replace(v, "[^A-Za-z]", "")),
        "joined_before": F.rlike(before, F.lit(r"[0-9A-Za-z_=/\"'.-]\z")), "joined_after": F.rlike(after, F.lit(r"\A(?:[0-9A-Za-z_=/\"'-]|\.[0-9])")),
        "keyword": _of_kind({k: F.rlike(F.lower(before), F.lit(KEYWORDS[k])) for k in KINDS}),
        "quoted": F.rlike(before, F.lit("[\"'`]\\z")), "hex_near": F.rlike(F.concat(before, after), F.lit("[0-9a-f]{12}")),
        "other_name": F.rlike(F.lower(before), F.lit(OTHER_NAMES)),
        **{c: F.col(c) for c in ("right_before", "valid", "ending", "issuer")}}
    return p.select("*", *[c.cast("double").alias(f"f_{n}") for n, c in values.items()], F.col("rank").cast("double").alias("f_rank"))


def _labels(p: DataFrame) -> DataFrame:
    """``label``: 1 for base spans, for proposals whose value, disguise undone,
    stands elsewhere as a base span, and for those with evidence beside a
    passed check (weak labels: the trees only learn from them); else 0."""
    same = F.when(F.col("rank").isin(KINDS.index("card"), KINDS.index("phone")), _digits(F.col("plain"))).otherwise(F.lower("plain"))
    p = p.withColumn("same", F.xxhash64("rank", same))
    base = written(p.filter("known").select(F.col("same").alias("base_value")).distinct(), "pii-values")
    alone = (F.col("f_joined_before") == 0) & (F.col("f_joined_after") == 0)
    evidence = F.col("valid") & _of_kind({
        "email": F.col("ending"), "ip": F.lit(True), "phone": F.col("right_before"),
        "card": alone & (F.col("issuer") | F.col("right_before"))})
    return (p.join(base, p["same"] == base["base_value"], "left")
            .withColumn("label", (F.col("known") | F.col("base_value").isNotNull() | evidence).cast("double")).drop("same", "base_value"))


def _assemble(p: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"f_{n}" for n in FEATURES], outputCol="features").transform(p)


def _proposals(found: DataFrame) -> DataFrame:
    """One row per proposal.  ``known``: a base span of its kind overlaps it, so
    it is that span seen otherwise; ``free``: it may be added, as no such span
    and, for bare numbers, no base span of any kind overlaps it."""
    over = (F.col("p.start"), F.col("p.end"))
    overlap = F.exists("base", lambda b: (b["rank"] == F.col("p.rank")) & (b["start"] < over[1]) & (over[0] < b["end"]))
    bare = F.col("p.rank").isin(KINDS.index("card"), KINDS.index("phone"))
    taken = F.exists("base", lambda b: (bare | (b["rank"] == F.col("p.rank"))) & (b["start"] < over[1]) & (over[0] < b["end"]))
    return (found.filter(F.size("proposals") > 0).dropDuplicates(["key", "text_key"])
            .select("key", "text_key", "base", F.explode("proposals").alias("p"))
            .select("key", "text_key", "p.*", overlap.alias("known"), (~taken).alias("free")))


def _thresholds(scored: DataFrame, precision: float, z: float) -> dict[int, tuple]:
    """kind -> (lowest score, precision, recall, rows): the lowest score (in
    hundredths) from which on held-out proposals are positive with the wanted
    precision: over all of them as the lower end of a confidence interval, and
    among those that may be added as it stands."""
    counts = scored.groupBy("rank", F.floor(F.col("score") * 100).alias("bin")).agg(
        F.sum("label").alias("good"), F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("open"), F.col("label")).otherwise(0.0)).alias("open_good"), F.count_if("open").alias("open_n")).collect()   # <= kinds x 101 rows
    cut = {}
    for rank in range(len(KINDS)):
        rows = sorted((r for r in counts if r["rank"] == rank), key=lambda r: -r["bin"])
        every = sum(r["good"] for r in rows)
        good = n = open_good = open_n = 0
        for r in rows:
            good, n, open_good, open_n = good + r["good"], n + r["n"], open_good + r["open_good"], open_n + r["open_n"]
            share = good / n
            middle, width = share + z * z / (2 * n), z * sqrt(share * (1 - share) / n + z * z / (4 * n * n))
            if (middle - width) / (1 + z * z / n) >= precision and open_good >= precision * open_n:
                cut[rank] = r["bin"] / 100, share, good / every, n
    return cut


def _training_sample(p: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` of the training half, in equal parts by kind and label
    (all of those that have fewer).  Copies of a value in its context count
    once, so no value fills the sample."""
    distinct = written(p.filter("mark % 2 = 0").dropDuplicates(["like", "label"])
                       .select("rank", "label", "like", *[f"f_{n}" for n in FEATURES]), "pii-distinct")
    strata = {(r["rank"], r["label"]): r["count"] for r in distinct.groupBy("rank", "label").count().collect()}   # <= 2 x kinds
    left, share = rows, None
    for n, (k, size) in enumerate(sorted(strata.items(), key=lambda x: (x[1], x[0]))):
        part = min(size, left // (len(strata) - n))                                    # small strata leave room to others
        left -= part
        hit, of = (F.col("rank") == k[0]) & (F.col("label") == k[1]), F.lit(-(-part * 1_000_000 // size))
        share = F.when(hit, of) if share is None else share.when(hit, of)
    return distinct if share is None else distinct.filter(F.pmod(F.xxhash64("like", F.lit(SEED + 1)), F.lit(1_000_000)) < share)


def _scored(found: DataFrame, train_rows: int, precision: float, z: float):
    """(proposals with score, thresholds by kind); (None, {}) if there is
    nothing to tell apart."""
    p = _labels(_features(_checks(_proposals(found))))
    p = written(p.select(
        "key", "text_key", "rank", "start", "end", F.col("free").alias("open"), "label",
        F.xxhash64("value", "before", "rank", F.lit(SEED)).alias("mark"),
        F.xxhash64("value", "before", "after", "rank").alias("like"),
        *[f"f_{n}" for n in FEATURES]), "pii-proposals")
    train = _training_sample(p, train_rows)
    if train.select("label").distinct().count() < 2:
        return None, {}
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, stepSize=0.3).fit(
        written(_assemble(train).select("features", "label"), "pii-train"))
    scored = model.transform(_assemble(p)).withColumn("score", vector_to_array("probability")[1]).select(
        "key", "text_key", "rank", "start", "end", "open", "label", "mark", "score")
    scored = written(scored, "pii-scored")
    return scored, _thresholds(scored.filter("mark % 2 <> 0"), precision, z)


def _chosen(scored: DataFrame, cut: dict) -> DataFrame:
    least = _of_kind({k: F.lit(cut[i][0] if i in cut else 2.0) for i, k in enumerate(KINDS)})
    return scored.filter(F.col("open") & (F.col("score") >= least))


def selection_report(docs: DataFrame, key: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS,
                     precision: float = PRECISION, z: float = Z) -> list[dict]:
    """Per kind: proposals, those that may be added, those the trees add, the
    threshold and its held-out precision and recall (none: nothing is added)."""
    scored, cut = _scored(written(find_base(docs, key, text), "pii-found"), train_rows, precision, z)
    if scored is None:
        return []
    added = {r["rank"]: r["count"] for r in _chosen(scored, cut).groupBy("rank").count().collect()}
    return [{"kind": KINDS[r["rank"]], "proposals": r["n"], "open": r["o"], "added": added.get(r["rank"], 0),
             **dict(zip(("threshold", "precision", "recall", "held_out"), cut.get(r["rank"], (None,) * 4)))}
            for r in scored.groupBy("rank").agg(F.count(F.lit(1)).alias("n"), F.count_if("open").alias("o")).orderBy("rank").collect()]


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS,
                       precision: float = PRECISION, z: float = Z) -> DataFrame:
    """(key, text_key, base, spans) per row: arrays of struct<rank, start, end>
    by kind and start; ``spans`` holds the base spans and those the trees add:
    every proposal that no base span overlaps is scored, and the score must
    reach its kind's threshold.

    Null and empty texts have no spans; repeated rows are scored once and
    reported each; without both positive and negative proposals no trees are
    fitted, and a kind whose held-out rows cannot show the precision has no
    threshold: nothing is added then; an empty table gives an empty result;
    further columns are not read.
    """
    found = written(find_base(docs, key, text), "pii-found")
    scored, cut = _scored(found, train_rows, precision, z)
    d = found.select("key", "text_key", "base")
    if not cut:
        return d.select(F.col("key").alias(key), "text_key", "base", F.array_sort("base").alias("spans"))
    added = _best_of_overlapping(_chosen(scored, cut).select("key", "text_key", "rank", "start", "end", "score"))
    d = d.join(added, d["key"].eqNullSafe(added["k"]) & (d["text_key"] == added["t"]), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<rank:int,start:int,end:int>>"))))
    return d.select(F.col("key").alias(key), "text_key", "base", spans.alias("spans"))


def _best_of_overlapping(fresh: DataFrame) -> DataFrame:
    """(k, t, added): of proposals of a kind that form an overlapping run, the
    best (score, length, first) stays."""
    place = Window.partitionBy("key", "text_key", "rank").orderBy("start", "end")
    before = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    run = F.sum(F.when(F.col("start") >= before, 1).otherwise(0)).over(place)
    best = F.max(F.struct("score", (F.col("end") - F.col("start")).alias("size"), (-F.col("start")).alias("first"), "start", "end"))
    return (fresh.withColumn("run", run).groupBy("key", "text_key", "rank", "run").agg(best.alias("b"))
            .groupBy(F.col("key").alias("k"), F.col("text_key").alias("t"))
            .agg(F.collect_list(F.struct("rank", "b.start", "b.end")).alias("added")))


# ------------------------------------------------------------------ results --

def span_names(spans: str) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rank"] == KINDS.index(kind))).cast("long")


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets (of spans that
    overlap, the first by start and kind covers the others); other columns and
    rows without spans unchanged."""
    found = find_personal_data(docs, key, text, **options).filter(F.size("spans") > 0)
    found = found.select(F.col(key).alias("_k"), "text_key", "spans").dropDuplicates(["_k", "text_key"]) \
        .withColumnRenamed("text_key", "_t").withColumnRenamed("spans", "_spans")
    found = if_small(written(found, "pii-spans"), F.size("_spans") + 1)
    joined = docs.join(found, docs[key].eqNullSafe(found["_k"]) & (F.xxhash64(docs[text]) == found["_t"]), "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"))))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        piece = F.concat(F.substr(docs[text], acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["rank"]))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.array_append(acc["out"], piece).alias("out"))) \
            .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    def close(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substr(docs[text], acc["at"] + 1, F.length(docs[text])))

    clean = F.when(F.col("_k").isNull() & F.col("_spans").isNull(), docs[text]).otherwise(F.aggregate(by_start, begin, step, close))
    return joined.select(*[clean.alias(c) if c == text else docs[c] for c in docs.columns])
