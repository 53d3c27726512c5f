"""Personal data by weak supervision, in DataFrame functions only.

Every whole text is searched for candidate spans: all matches of the base
patterns, whether or not they pass their check, and looser spellings (an
e-mail address with "at" and "dot" written out, a telephone number without
its country code). Four labelers vote for, against or not at all on each:

* rule: the base pattern's own check (octets, Luhn digit, digit counts);
* gazetteer: known top-level domains, issuer digits, address blocks, the
  leading digits of calling codes;
* context: words of the 40 characters before the span;
* shape: digit counts and separators that fit the kind.

Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is for each kind and how likely a pattern is personal
data. A final classifier (log odds of hashed features: the previous word and
the span's shape, besides the votes) is trained on those probabilities and
decides about the candidates that no base rule has. Base spans always stay;
a candidate that touches one never joins.

The driver sees at most 324 counts of vote patterns and a fixed number of
feature sums; texts are read once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetspark.llm.common import LEAN_PARQUET, col, stored
from facetspark.session import scratch_dir

KINDS = ("email", "ip", "card", "phone")
# fixed values: the base patterns. Possessive loops and the guard against
# starting inside a run that has failed already keep them linear; they match
# what the plain ones match (\G: right after the last match).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){13,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOOSE_EMAIL = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?\[at\]\x20?|\x20?\(at\)\x20?)[A-Za-z0-9-]++"
               r"(?:(?:\x20?\[dot\]\x20?|\x20?\(dot\)\x20?|\.)[A-Za-z0-9-]++)++")
LOOSE_PHONE = r"(?<![0-9+.(-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9]|[\x20.-][0-9])"
# fixed values: gazetteers
DOMAINS = ("com org net edu gov mil int info biz name example test io co app dev eu us uk de fr es it nl be ch at se no "
           "dk fi pl pt ru ua cz gr ie jp cn kr in au nz ca mx br ar za").split()
CONTEXT = (
    (r"(?i)(?:mail|contact|write|reach|send|kontakt|correo|courriel|address)", r"(?i)(?:git|ssh|regex|pattern)"),
    (r"(?i)(?:\bip\b|host|server|address|client|login|from|adresse)", r"(?i)(?:version|release|section|chapter|\bv\.?\s*$)"),
    (r"(?i)(?:card|visa|master|credit|debit|payment|karte|tarjeta|carte)",
     r"(?i)(?:isbn|invoice|order|tracking|serial|hash|token|account id)"),
    (r"(?i)(?:phone|call|tel\b|tel\.|fax|mobile|cell|whatsapp|telefon|tél|teléfono)",
     r"(?i)(?:isbn|invoice|order|version|range|serial|price)"),
)
WORD_SLOTS, SHAPE_SLOTS = 256, 64
_SPAN = "array<struct<start:long,kind:int,end:long,value:string,before:string>>"


def _matches(text: Column, pattern: str, kind: int, first: str | None = None) -> Column:
    """Spans of all matches of ``pattern``; ``first``: a string without which
    there is none."""
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"),
            F.right(x["gap"], F.lit(40)).alias("before")))).alias("spans"))

    pairs = F.zip_with(between, value, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    pairs = F.filter(pairs, lambda x: x["value"].isNotNull())
    spans = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("spans")),
                        step, lambda acc: acc["spans"])
    may = F.instr(text, first) > 0 if first else text.rlike(pattern)
    return F.when(may, spans).otherwise(F.array().cast(_SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _octets_fit(value: Column) -> Column:
    part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
    return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (
        F.substring(part(p), 1, 3).cast("int") <= 255))


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(x: Column, strict: bool) -> Column:
    """A span with its base decision and the labelers' votes (+1, 0, -1)."""
    kind, value, before = x["kind"], x["value"], x["before"]
    digits, n = _digits(value), F.length(_digits(value))
    passes = F.when(kind == 0, True).when(kind == 1, _octets_fit(value)).when(
        kind == 2, n.between(14, 19) & _luhn(F.substring(digits, 1, 19))).otherwise(n.between(10, 15))
    base = passes if strict else F.lit(False)
    domain = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1))
    lead = F.substring_index(value, ".", 1).cast("int")
    gazetteer = F.when(kind == 0, _sign(domain.isin(DOMAINS), ~domain.rlike("^[a-z]{2,}$"))).when(
        kind == 1, _sign(lead.between(1, 223), (lead == 0) | (lead > 223))).when(
        kind == 2, _sign(F.substring(digits, 1, 1).isin("3", "4", "5", "6"), F.substring(digits, 1, 1).isin("0", "9"))
    ).otherwise(_sign(F.substring(digits, 1, 1).between("1", "9"), F.substring(digits, 1, 1) == "0"))
    context = F.lit(0)
    for k, (yes, no) in enumerate(CONTEXT):
        context = F.when(kind == k, _sign(before.rlike(yes), before.rlike(no))).otherwise(context)
    shape = F.when(kind == 0, _sign(F.length(value).between(6, 80), F.length(value) > 254)).when(
        kind == 1, _sign(F.length(value) <= 15, F.length(value) > 15)).when(
        kind == 2, _sign(n.isin(14, 15, 16), n > 19)).otherwise(_sign(n.between(10, 15), ~n.between(7, 15)))
    rule = F.when(passes, 1).otherwise(-1) if strict else F.lit(0)
    votes = [rule, gazetteer, context, shape]
    pattern = F.lit(0)
    for v in votes:
        pattern = pattern * 3 + v + 1
    word = F.lower(F.regexp_extract(before, r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$", 1))
    form = F.regexp_replace(F.regexp_replace(value, "[0-9]+", "9"), "[A-Za-z]+", "a")
    return F.struct(x["start"].alias("start"), kind.alias("kind"), x["end"].alias("end"), base.alias("base"),
                    (kind * 81 + pattern).cast("int").alias("votes"),
                    (kind * WORD_SLOTS + F.pmod(F.hash(word), F.lit(WORD_SLOTS))).alias("word"),
                    (kind * SHAPE_SLOTS + F.pmod(F.hash(F.substring(form, 1, 32)), F.lit(SHAPE_SLOTS))).alias("form"))


def with_spans(df: DataFrame, text_col: str, into: str = "__spans") -> DataFrame:
    """Adds the judged candidates of every row; those that touch a base span
    of any kind are left out."""
    t = F.coalesce(col(text_col), F.lit(""))
    strict = F.concat(_matches(t, EMAIL, 0, "@"), _matches(t, IP, 1), _matches(t, CARD, 2), _matches(t, PHONE, 3, "+"))
    loose = F.concat(_matches(t, LOOSE_EMAIL, 0), _matches(t, LOOSE_PHONE, 3))
    d = df.withColumn("__strict", F.transform(strict, lambda x: _judged(x, True)))
    d = d.withColumn("__loose", F.transform(loose, lambda x: _judged(x, False)))
    others = F.filter(F.concat("__strict", "__loose"), lambda x: ~x["base"] & ~F.exists(
        F.filter("__strict", lambda y: y["base"]), lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    some = (F.size("__strict") > 0) | (F.size("__loose") > 0)
    return d.withColumn(into, F.when(some, F.concat(F.filter("__strict", lambda x: x["base"]), others)).otherwise(
        F.col("__strict"))).drop("__strict", "__loose")


def reliabilities(counts: dict[int, int], rounds: int = 40) -> list[float]:
    """Probability of personal data for each vote pattern (kind * 81 + code).

    Expectation-maximisation for two classes, per kind: a share of true spans
    and, per labeler and class, the probabilities of its three votes. It
    starts from the majority of votes.
    """
    digits = lambda code: [code // 27 % 3, code // 9 % 3, code // 3 % 3, code % 3]
    out = [0.0] * (81 * len(KINDS))
    for kind in range(len(KINDS)):
        codes = {c: counts.get(kind * 81 + c, 0) for c in range(81)}
        post = {c: 1 / (1 + math.exp(-(sum(digits(c)) - 4))) for c in codes}
        for _ in range(rounds):
            mass = [1.0, 1.0]
            vote = [[[1.0 / 3] * 3 for _ in range(4)] for _ in range(2)]
            for c, n in codes.items():
                for y, w in ((1, n * post[c]), (0, n * (1 - post[c]))):
                    mass[y] += w
                    for labeler, v in enumerate(digits(c)):
                        vote[y][labeler][v] += w
            for c in codes:
                odds = math.log(mass[1] / mass[0])
                for labeler, v in enumerate(digits(c)):
                    odds += math.log(vote[1][labeler][v] / mass[1]) - math.log(vote[0][labeler][v] / mass[0])
                post[c] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        # the classes are named by the votes: true is the one the rule labeler sides with
        yes = sum(codes[c] * post[c] * (digits(c)[0] - 1) for c in codes)
        no = sum(codes[c] * (1 - post[c]) * (digits(c)[0] - 1) for c in codes)
        for c in codes:
            out[kind * 81 + c] = post[c] if yes >= no else 1 - post[c]
    return out


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def span_classifier(candidates: DataFrame) -> Callable[[Column], Column]:
    """Trains on a column ``spans`` of judged candidates; gives the function
    that keeps an array's base spans and those the classifier takes for
    personal data."""
    each = candidates.where(F.size("spans") > 0).select(F.explode("spans").alias("s")).select("s.*")
    counts = {r[0]: r[1] for r in each.groupBy("votes").count().collect()}  # at most 324 rows
    likely = reliabilities(counts)
    each = each.withColumn("p", F.get(F.array(*[F.lit(x) for x in likely]), F.col("votes")))
    weights = {}
    for feature, slots in (("word", WORD_SLOTS), ("form", SHAPE_SLOTS)):
        w = [0.0] * (slots * len(KINDS))
        for slot, yes, n in each.groupBy(feature).agg(F.sum("p"), F.count("p")).collect():  # fixed number of slots
            w[slot] = yes, n
        for k in range(len(KINDS)):
            part = [x for x in w[k * slots:(k + 1) * slots] if x != 0.0]
            yes, n = sum(x[0] for x in part), sum(x[1] for x in part)
            for i in range(k * slots, (k + 1) * slots):
                if w[i] != 0.0:
                    a, b = w[i][0] + 0.5, w[i][1] - w[i][0] + 0.5
                    w[i] = math.log(a / (yes + 1)) - math.log(b / (n - yes + 1))
        weights[feature] = F.array(*[F.lit(float(x)) for x in w])
    odds = F.array(*[F.lit(_logit(x)) for x in likely])
    is_true = lambda s: F.get(odds, s["votes"]) + 0.5 * (
        F.get(weights["word"], s["word"]) + F.get(weights["form"], s["form"])) > 0
    return lambda spans: F.array_sort(F.transform(F.filter(spans, lambda s: s["base"] | is_true(s)), _bare))


def _bare(s: Column) -> Column:
    return F.struct(s["start"], s["kind"], s["end"])


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, found): per row the base spans and all spans found, as
    arrays of struct(start, kind, end) ordered by them; kind counts from 0 in
    the order of ``KINDS``, ends are exclusive, in code points.

    A null text is empty. Rows are searched one by one: equal rows get equal
    spans, and null or repeated ids are carried as they are. An empty table
    gives an empty result.
    """
    texts = df.select(col(id_col).alias("__id"), col(text_col).alias("__t"))
    found = stored(with_spans(texts, "__t", "spans").select("__id", "spans"))
    accept = span_classifier(found)
    return found.select(F.col("__id").alias(id_col), F.array_sort(F.transform(
        F.filter("spans", lambda s: s["base"]), _bare)).alias("base"), accept(F.col("spans")).alias("found"))


def spelled(a: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(a, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets;
    overlapping spans are replaced as one, under the first one's kind."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    done = F.aggregate(found, start, lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(
            acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
            F.get(names, s["kind"]))).alias("out")))
    return F.when(F.size(found) > 0, F.concat(done["out"], F.substring(
        text, (done["at"] + 1).cast("int"), F.lit(2**31 - 1)))).otherwise(text)


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with every span found in ``text_col`` replaced by its kind.

    Needs no id. Each text is searched once: rows and their candidate spans are
    written together, the classifier trains on the spans (column pruning keeps
    the texts out of that pass), and the stored rows are replaced. Null texts
    stay null.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, "spans")
    with_spans(df, text_col, "__spans").write.options(**LEAN_PARQUET).parquet(path)
    held = spark.read.parquet(path)
    accept = span_classifier(held.select(F.col("__spans").alias("spans")).where(F.size("spans") > 0))
    d = held.withColumn("__found", accept(F.col("__spans")))
    return d.select(*[redacted(col(c), F.col("__found")).alias(c) if c == text_col else col(c) for c in df.columns])
