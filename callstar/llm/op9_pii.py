"""Personal data by weak supervision, in DataFrame functions only.

Base patterns give the certain spans; wide patterns give further candidates.
Regex, gazetteer and context labelers vote on every candidate (1 personal data,
-1 not, 0 abstain). Expectation-maximisation over the counts of the vote
patterns (a few hundred at most, counted over all candidates) estimates each
labeler's reliability; its posteriors train a naive Bayes classifier on features
of the spans (again from counts over all candidates), which decides on every
candidate that is not a base span. Base spans always stay.

Matches with positions: ``split`` gives the gaps between the matches that
``regexp_extract_all`` gives, so a running sum of their lengths within a text is
where each match starts. Patterns begin at the start of a run and use
possessive repeats, so long runs take linear time and no stack.

Defined cases: null or empty text has no spans; spans are in code points, end
exclusive; a very long text is one row with many spans; repeated rows are
reported once each; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callstar.llm.common import stage, with_row_id

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: Where a run begins: after another character, or where the match before ended.
_RUN = r"(?:\G|(?<!%s))"
BASE = {
    "email": (_RUN % _LOCAL) + _LOCAL + r"++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": (_RUN % "[0-9]") + r"[0-9]++(?:\.[0-9]++){3}",
    # the base run with 13 digits or more; shorter ones never pass
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": (_RUN % _LOCAL) + _LOCAL + r"++(?:\x20?+[\(\[]at[\)\]]\x20?+)[A-Za-z0-9-]++(?:(?:\.|\x20?+[\(\[]dot[\)\]]\x20?+)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9._/])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9._/])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)[\x20.-]?|00[1-9][0-9]?[\x20.-]|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
#: A text without these characters has no match.
NEEDS = {"email": r"@|[\(\[]at[\)\]]", "ip": "[0-9][.:][0-9]|:[0-9A-Fa-f]", "card": "[0-9]{4}|[0-9][\\x20-][0-9]", "phone": r"\+[0-9]|[0-9]{3}"}

# gazetteers
TOP_DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "it", "nl", "eu", "ch", "at")
COUNTRY_CODES = r"^(?:\+|00)(?:1|20|27|3[0-9]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|36|38|6011|64|65)"
RESERVED_IP = r"^(?:0|10|127|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
POSITIVE = {
    "email": ("email", "mail", "contact", "courriel", "correo", "write", "reach"),
    "ip": ("ip", "host", "address", "server", "client", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "carte", "karte", "tarjeta", "pan"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "cell", "telefon", "téléphone", "teléfono"),
}
NEGATIVE = ("order", "invoice", "isbn", "issn", "version", "serial", "id", "ref", "page", "total", "sum", "build", "release")
LABELERS = 5
#: Posterior from which the classifier adds a span.
SURE = 0.9
BUCKETS = 128
ROUNDS = 40


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum of a digit string holds."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int"))
                         .when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2))
    return F.aggregate(values, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))) % 10 == 0


def _octets(c: Column) -> Column:
    return F.forall(F.split(c, r"\."), lambda x: F.coalesce(
        (F.length(F.regexp_replace(x, "^0+(?=.)", "")) <= 3) & (F.substring(F.regexp_replace(x, "^0+(?=.)", ""), 1, 3).try_cast("int") <= 255), F.lit(False)))


def valid(kind: Column, text: Column) -> Column:
    """The base conditions on a match."""
    n = F.length(_digits(text))
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", _octets(text))
            .when(kind == "card", (n >= 13) & (n <= 19) & _luhn(F.substring(_digits(text), 1, 20)))
            .otherwise((n >= 9) & (n <= 15)))


def matches(rows: DataFrame) -> DataFrame:
    """uid, doc_id, kind, wide, start, end, found, before: all matches of the base and wide patterns."""
    def of(kind: str, wide: bool) -> Column:
        pattern = F.lit((WIDE if wide else BASE)[kind])
        # pieces are split once and matched once: the pair goes through the lambda as one array
        pairs = F.arrays_zip(F.split("text", (WIDE if wide else BASE)[kind], -1).alias("gap"),
                             F.regexp_extract_all("text", pattern, F.lit(0)).alias("found"))
        made = F.transform(pairs, lambda p, i: F.struct(
            F.lit(kind).alias("kind"), F.lit(wide).alias("wide"), i.alias("i"), F.char_length(p["gap"]).cast("long").alias("gap"),
            F.right(p["gap"], F.lit(40)).alias("before"), p["found"].alias("found")))
        return F.filter(made, lambda m: m["found"].isNotNull())

    # a cheap test of the characters first
    gated = [F.when(F.col("text").rlike(NEEDS[k]), of(k, w)) for k in KINDS for w in (False, True)]
    empty = F.array().cast("array<struct<kind:string,wide:boolean,i:int,gap:bigint,before:string,found:string>>")
    arrays = F.concat(*(F.coalesce(g, empty) for g in gated))
    one = rows.select("uid", "doc_id", F.inline(arrays))
    order = Window.partitionBy("uid", "kind", "wide").orderBy("i")
    size = F.char_length("found").cast("long")
    return (one.withColumn("end", F.sum(F.col("gap") + size).over(order))
            .select("uid", "doc_id", "kind", "wide", (F.col("end") - size).alias("start"), "end", "found", "before"))


def labelled(found: DataFrame) -> DataFrame:
    """Add the votes v0..v4 and the features x0..x4 of each candidate."""
    kind, text = F.col("kind"), F.col("found")
    n = F.length(_digits(text))
    base = ~F.col("wide") & valid(kind, text)
    word = F.lower(F.regexp_extract("before", r"([\p{L}]+)[^\p{L}]*$", 1))
    positive = F.lit(False)
    for k, words in POSITIVE.items():
        positive = positive | ((kind == k) & word.isin(*words))
    yes_no = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(-1))
    votes = [
        # regex: the strict form holds, fails, or is not asked
        F.when(F.col("wide"), F.lit(0)).otherwise(yes_no(F.col("base"))),
        # regex: checks on the digits or the name
        F.when(kind == "card", yes_no((n >= 13) & (n <= 19) & _luhn(F.substring(_digits(text), 1, 20))))
        .when(kind == "phone", yes_no((n >= 10) & (n <= 13))).when(kind == "email", yes_no(F.length(text) <= 64)).otherwise(F.lit(0)),
        # gazetteer: top domains, issuers, country codes, reserved networks
        F.when(kind == "email", yes_no(F.lower(F.regexp_extract(text, r"([A-Za-z0-9-]+)$", 1)).isin(*TOP_DOMAINS)))
        .when(kind == "card", yes_no(_digits(text).rlike(ISSUERS)))
        .when(kind == "phone", F.when(text.rlike(COUNTRY_CODES), F.lit(1)).otherwise(F.lit(0)))
        .otherwise(F.when(text.rlike(RESERVED_IP), F.lit(-1)).otherwise(F.lit(0))),
        # context: the word before
        F.when(positive, F.lit(1)).when(word.isin(*NEGATIVE), F.lit(-1)).otherwise(F.lit(0)),
        # context: glued to what stands before
        F.when(F.col("before").rlike(r"[A-Za-z0-9_=/#]$"), F.lit(-1)).otherwise(F.lit(0)),
    ]
    shape = F.substring(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "[0-9]+", "9"), "[A-Za-z]+", "a"), "(.)\\1+", "$1"), 1, 24)
    bucket = lambda c: F.pmod(F.xxhash64(kind, c), F.lit(BUCKETS)).cast("int")
    features = [bucket(shape), bucket(F.length(text)), bucket(n), bucket(word), bucket(F.right("before", F.lit(1)))]
    out = found.withColumn("base", base)
    out = out.select("*", *(v.alias(f"v{i}") for i, v in enumerate(votes)), *(x.alias(f"x{i}") for i, x in enumerate(features)))
    return out


def reliabilities(patterns: list[tuple]) -> tuple[dict, list[dict]]:
    """EM over rows of (kind, votes..., count): the prior of each kind and each labeler's log odds by vote."""
    start = lambda votes: 1 / (1 + math.exp(-1.5 * sum(votes)))  # noqa: E731  majority first
    posterior = [start(p[1:-1]) for p in patterns]
    prior, odds = {}, []
    for _ in range(ROUNDS):
        for kind in KINDS:
            pairs = [(q, p[-1]) for q, p in zip(posterior, patterns) if p[0] == kind]
            total, yes = sum(c for _, c in pairs), sum(q * c for q, c in pairs)
            prior[kind] = math.log((yes + 1) / (total - yes + 1))
        odds = []
        for j in range(LABELERS):
            counts = {v: [0.5, 0.5] for v in (-1, 0, 1)}
            for q, p in zip(posterior, patterns):
                counts[p[1 + j]][0] += (1 - q) * p[-1]
                counts[p[1 + j]][1] += q * p[-1]
            no, yes = (sum(c[k] for c in counts.values()) for k in (0, 1))
            # a labeler is never taken for worse than chance
            raw = {v: math.log(c[1] / yes) - math.log(c[0] / no) for v, c in counts.items()}
            odds.append({-1: min(0.0, raw[-1]), 0: raw[0] if abs(raw[0]) < 0.5 else math.copysign(0.5, raw[0]), 1: max(0.0, raw[1])})
        posterior = [1 / (1 + math.exp(-max(-30, min(30, prior[p[0]] + sum(o[v] for o, v in zip(odds, p[1:-1])))))) for p in patterns]
    return prior, odds


def classify(candidates: DataFrame) -> DataFrame:
    """Add ``personal``, the classifier's probability, to labelled candidates."""
    votes, features = [f"v{i}" for i in range(LABELERS)], [f"x{i}" for i in range(5)]
    patterns = [tuple(r) for r in candidates.groupBy("kind", *votes).agg(F.count("*").alias("n")).collect()]  # at most 4 * 3**5
    if not patterns:
        return candidates.withColumn("personal", F.lit(0.0))
    prior, odds = reliabilities(patterns)
    log = F.lit(0.0)
    for k in KINDS:
        log = log + F.when(F.col("kind") == k, F.lit(prior[k])).otherwise(F.lit(0.0))
    for v, o in zip(votes, odds):
        log = log + F.when(F.col(v) == 1, F.lit(o[1])).when(F.col(v) == -1, F.lit(o[-1])).otherwise(F.lit(o[0]))
    soft = candidates.withColumn("q", 1 / (1 + F.exp(-log)))
    # naive Bayes from soft counts: at most features * BUCKETS rows come back
    sums = (soft.select("q", F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.col(x).alias("b")) for i, x in enumerate(features)))).alias("x"))
            .groupBy("x.f", "x.b").agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no")).collect())
    weights = [[0.0] * BUCKETS for _ in features]
    totals = [[sum(r[k] for r in sums if r["f"] == i) for k in ("yes", "no")] for i in range(len(features))]
    for r in sums:
        yes, no = totals[r["f"]]
        weights[r["f"]][r["b"]] = math.log((r["yes"] + 0.1) / (yes + 0.1 * BUCKETS)) - math.log((r["no"] + 0.1) / (no + 0.1 * BUCKETS))
    final = log  # the reliabilities' log odds, and what the features add
    for x, w in zip(features, weights):
        final = final + F.element_at(F.array(*(F.lit(round(v, 6)) for v in w)), F.col(x) + 1) * F.lit(0.2)
    return candidates.withColumn("personal", 1 / (1 + F.exp(-final)))


def find(documents: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: a row per row of ``documents`` (a file scan)."""
    rows = with_row_id(documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "uid")
    candidates = stage(labelled(matches(rows)), "spans")
    judged = classify(candidates).filter(F.col("base") | (F.col("personal") >= SURE))
    rank = F.element_at(F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i))), F.col("kind"))
    judged = judged.withColumn("rank", rank)
    # an added span that overlaps a base span (or an earlier added one) of its kind is part of it
    reach = Window.partitionBy("uid", "kind").orderBy("start", "end")
    nearest = (judged.withColumn("base_end", F.max(F.when(F.col("base"), F.col("end"))).over(reach.rowsBetween(Window.unboundedPreceding, -1)))
               .withColumn("base_start", F.min(F.when(F.col("base"), F.col("start"))).over(reach.rowsBetween(1, Window.unboundedFollowing)))
               .withColumn("added_end", F.max("end").over(reach.rowsBetween(Window.unboundedPreceding, -1))))
    free = ((F.coalesce("base_end", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("base_start") >= F.col("end"), F.lit(True))
            & (F.coalesce("added_end", F.lit(0)) <= F.col("start")))
    kept = nearest.filter(F.col("base") | free).drop("base_end", "base_start", "added_end")
    item = F.struct("rank", "start", "end", "kind", "base")
    per_text = kept.groupBy("uid").agg(
        *(F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS),
        F.count_if(~F.col("base")).alias("n_added"), F.sort_array(F.collect_list(item)).alias("items"))
    written = lambda items: F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    per_text = per_text.withColumn("base_spans", written(F.filter("items", lambda s: s["base"]))).withColumn("spans", written(F.col("items"))).drop("items")
    out = rows.select("uid", "doc_id").join(per_text, "uid", "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", *(none(f"n_{k}") for k in KINDS), F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
                      F.coalesce("spans", F.lit("")).alias("spans"), none("n_added"))
