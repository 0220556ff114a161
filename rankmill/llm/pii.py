"""Personal data: generators propose spans, boosted trees score them, calibrated thresholds decide.

Base spans follow fixed formats (email, ip, card, phone) and always stay. Beyond them, generators of
high recall propose further spans of the same kinds - written-out addresses, national phone numbers,
card and host numbers with unusual separators - which overlap one another and much that is harmless.
Gradient boosted trees score a proposal by its format (digits, groups, separators, checksum) and its
context (cue words before it, characters next to it). A proposal becomes a span when its score
reaches the threshold of its kind; of overlapping ones the one with the highest calibrated probability
stays (ties: the kind listed first), and none that touches a base span.

The trees are trained here: `TRAINING_ROWS` labelled texts are made by Spark from templates of
personal data and of look-alikes (order numbers, dates, versions, prices, book numbers), cut by the
same generators as the documents. The held-out quarter calibrates the scores by isotonic regression and
gives the thresholds: the lowest score at which precision is `PRECISION` or more. The fitted trees
become nested CASE expressions, so documents are scored inside one projection: no shuffle, no Python,
no state across rows.

The work of a text grows with its length and, but for a logarithm, with its matches: offsets are running
sums taken in blocks, overlaps are found by binary search in spans sorted by start, context is read
from cells of the text and not from its beginning. A proposed mailbox has at most 64 characters and a
host label at most 63, the limits of mail and host names.

Null text is empty and has no spans. Offsets are code points, ends exclusive. Each row is judged by
itself: repeated rows give repeated results, an empty table gives none. Of the input only `doc_id` and
`text` are read, so further columns may have any name. Null ids stay null.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.llm.common import opened, stored, text_of, with_running

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 24
TRAINING_ROWS = 6000
TREES, DEPTH = 8, 3
PRECISION = 0.98
BINS = 50
SEED = 7
CELL = 256  # characters of a text cell; more than CONTEXT
STEPS = [2**k for k in range(28, -1, -1)]  # binary search over as many spans as a text can hold

SPAN = "array<struct<start:int,end:int,kind:string>>"

# The base formats. `(?<!x)x++` starts at the first character of a run only and never gives one back,
# which finds the same matches as `x+` without trying every start in a long run; `\G` admits the rest
# of a run behind the match before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

AT = r"(?:\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?|\x20(?:at|AT)\x20)"
DOT = r"(?:\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\x20(?:dot|DOT)\x20|\.)"
PROPOSALS = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{AT}[A-Za-z0-9-]{{1,63}}(?:{DOT}[A-Za-z0-9-]{{1,63}})+",
    "ip": rf"(?<![0-9])[0-9]{{1,3}}(?:{DOT}[0-9]{{1,3}}){{3}}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,3}[0-9]{4}){2,3}(?:[\x20._/-]{1,3}[0-9]{1,3})?(?![0-9])",
    "phone": r"(?<![0-9])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){1,4}(?![0-9])",
}
PROPOSAL_HINTS = {"email": r"(?i)at|@", "ip": r"[0-9]", "card": r"[0-9]{4}", "phone": r"[0-9]{2}"}

CUES = {
    "email": r"(?i)(e-?mail|mail|contact|write|reach)",
    "ip": r"(?i)(\bip\b|host|server|address|login from|gateway)",
    "card": r"(?i)(card|visa|master|amex|credit|debit|payment)",
    "phone": r"(?i)(tel|phone|call|mobile|fax|ring|whatsapp|dial)",
    "other": r"(?i)(order|invoice|isbn|version|\bv\.?$|page|date|ref|no\.|number|serial|price|sku|part)",
}
FEATURES = (
    *[f"is_{kind}" for kind in KINDS],
    *[f"cue_{cue}" for cue in CUES],
    "n_chars", "n_digits", "n_groups", "longest", "n_spaces", "n_dots", "n_dashes", "n_slashes", "n_brackets",
    "n_words", "luhn", "octets", "year", "near_before", "near_after",
)


class Model(NamedTuple):
    trees: list  # nested (feature, threshold, left, right) or a leaf value, with its weight
    thresholds: dict[str, float]
    calibrated: dict[str, list[float]]  # kind: probability by score bin, never falling
    held_out: dict[str, tuple[int, int, int]]  # kind: found and right, found, right


# -- spans --------------------------------------------------------------------------------


def _with_found(df: DataFrame, wanted: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Adds per name the matches of (kind, pattern, hint) in `text` as (kind, start, end, m); what
    `split` leaves between matches gives the places."""

    def strings(hint: str, value: Column) -> Column:
        return F.when(F.col("text").rlike(hint), value).otherwise(F.array().cast("array<string>"))

    cut = {}
    for name, (_, pattern, hint) in wanted.items():
        cut[f"{name}_m"] = strings(hint, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
        cut[f"{name}_g"] = strings(hint, F.split("text", pattern, -1))
    df = opened(df, **cut)

    def advance(name: str) -> Column:
        gaps = F.col(f"{name}_g")
        return F.transform(f"{name}_m", lambda m, i: F.char_length(m) + F.char_length(F.get(gaps, i)))

    def spans(name: str, kind: str) -> Column:
        ends = F.col(f"{name}_end")

        def span(m: Column, i: Column) -> Column:
            end = F.get(ends, i)
            return F.struct(
                F.lit(kind).alias("kind"), (end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("m")
            )

        return F.transform(f"{name}_m", span)

    df = with_running(df, {f"{name}_end": advance(name) for name in wanted})
    df = opened(df, **{name: spans(name, kind) for name, (kind, _, _) in wanted.items()})
    return df.drop(*cut, *[f"{name}_end" for name in wanted])


def _overlaps(s: Column, others: Column) -> Column:
    """Whether a span touches one of `others`, which are sorted by start and free of overlaps."""

    def further(low: Column, step: Column) -> Column:
        ahead = (low + step <= F.size(others)) & (F.get(others, low + step - 1)["start"] < s["end"])
        return F.when(ahead, low + step).otherwise(low)

    low = F.aggregate(F.lit(STEPS), F.lit(0), further)
    return F.when(F.size(others) == 0, False).otherwise(F.coalesce(F.get(others, low - 1)["end"] > s["start"], F.lit(False)))


def _cells(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CELL}}}"), F.lit(0))


def _cell(cells: Column, place: Column) -> Column:
    return F.coalesce(F.get(cells, place), F.lit(""))


def luhn_ok(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.char_length(digits).between(13, 19) & luhn_ok(digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def _base_of(kind: str) -> Column:
    valid = F.filter(f"all_{kind}", lambda s: _valid(kind, s["m"]))
    return F.transform(
        valid, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def _of_kind(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def _spans_of(df: DataFrame) -> DataFrame:
    """Adds the base spans of each kind and `proposed`, spans with their match, for the column `text`."""
    every = {f"all_{k}": (k, BASE[k], HINTS[k]) for k in KINDS}
    raw = {f"raw_{k}": (k, PROPOSALS[k], PROPOSAL_HINTS[k]) for k in KINDS}
    df = _with_found(df, every | raw)
    df = opened(df, **{f"base_{kind}": _base_of(kind) for kind in KINDS}).drop(*every)
    free = F.filter(
        F.concat(*[F.col(name) for name in raw]),
        lambda s: ~reduce(or_, [_overlaps(s, F.col(f"base_{kind}")) for kind in KINDS]),
    )
    df = opened(df, base=F.concat(*[F.col(f"base_{kind}") for kind in KINDS]), free=free)
    df = opened(df, cells=F.when(F.size("free") > 0, _cells(F.col("text"))))
    return opened(df, proposed=_with_features(F.col("cells"), F.col("free"))).drop("free", "cells", *raw)


def _with_features(cells: Column, spans: Column) -> Column:
    def features(s: Column) -> Column:
        m = s["m"]
        here, there = F.floor(s["start"] / CELL).cast("int"), F.floor(s["end"] / CELL).cast("int")
        lead = F.concat(_cell(cells, here - 1), F.substring(_cell(cells, here), F.lit(1), F.pmod(s["start"], F.lit(CELL))))
        before = F.right(lead, F.lit(CONTEXT))
        last = F.right(before, F.lit(1))
        following = F.substring(_cell(cells, there), F.pmod(s["end"], F.lit(CELL)) + 1, F.lit(1))
        digits = F.regexp_replace(m, "[^0-9]", "")
        groups = F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0))
        count = {
            "n_chars": F.char_length(m),
            "n_digits": F.char_length(digits),
            "n_groups": F.size(groups),
            "longest": F.coalesce(F.array_max(F.transform(groups, lambda g: F.char_length(g))), F.lit(0)),
            **{
                name: F.regexp_count(m, F.lit(pattern))
                for name, pattern in (
                    ("n_spaces", " "), ("n_dots", r"\."), ("n_dashes", "-"), ("n_slashes", "/"),
                    ("n_brackets", r"[\[\](){}<>]"), ("n_words", "[A-Za-z]{2,}"),
                )
            },
            "luhn": F.when(F.char_length(digits).between(13, 19), luhn_ok(digits).cast("int")).otherwise(0),
            "octets": m.rlike(rf"^{PART}(?:[^0-9]+{PART}){{3}}$").cast("int"),
            "year": m.rlike(r"(^|[^0-9])(19|20)[0-9]{2}($|[^0-9])").cast("int"),
            "near_before": last.rlike("[A-Za-z0-9@#$€]").cast("int"),
            "near_after": following.rlike("[A-Za-z0-9@%€$]").cast("int"),
            **{f"is_{kind}": (s["kind"] == kind).cast("int") for kind in KINDS},
            **{f"cue_{cue}": before.rlike(pattern).cast("int") for cue, pattern in CUES.items()},
        }
        return F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
            F.struct(*[count[name].cast("double").alias(name) for name in FEATURES]).alias("x"),
        )

    return F.transform(spans, features)


# -- training -----------------------------------------------------------------------------


def _digits(n: int, salt: int) -> Column:
    """n digits from the row number."""
    value = F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(10**n))
    return F.lpad(value.cast("string"), n, "0")


def _pick(options: tuple[str, ...], salt: int) -> Column:
    place = F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(len(options))) + 1
    return F.element_at(F.array(*[F.lit(o) for o in options]), place.cast("int"))


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def labelled_texts(spark: SparkSession, rows: int = TRAINING_ROWS) -> DataFrame:
    """(id, text, kind, label): texts with one span each of personal data or of a look-alike."""
    name = _joined(_pick(("anna", "j.smith", "li", "maria_k", "o.b", "team7", "kontakt"), 1), _digits(1, 2))
    host = _pick(("example", "mailbox", "corp-net", "uni-x", "firma"), 3)
    top = _pick(("com", "org", "net", "de", "fr"), 4)
    at = _pick((" at ", " AT ", " [at] ", "(at)", " <at> "), 5)
    dot = _pick((" dot ", ".", "[dot]", " (dot) ", " DOT "), 6)
    sep = _pick((" ", "-", ".", "/"), 7)
    card_sep = _pick((".", "_", "/", " - ", ".."), 8)
    stem = _joined("4", _digits(3, 9), _digits(4, 10), _digits(4, 11), _digits(3, 12))
    check = F.element_at(
        F.filter(F.sequence(F.lit(0), F.lit(9)), lambda d: luhn_ok(F.concat(stem, d.cast("string")))), 1
    ).cast("string")
    card = F.concat(stem, check)
    groups = [F.substring(card, k, 4) for k in (1, 5, 9, 13)]
    octet = [F.pmod(F.xxhash64(F.col("id"), F.lit(20 + k)), F.lit(256)).cast("string") for k in range(4)]
    gap = _pick((" ", ": ", " = ", " is ", ", "), 30)
    tel = _pick(("tel", "Tel.", "phone", "call", "mobile", "Fax", "ring us on"), 31)
    other = _pick(("order", "invoice", "ISBN", "ref", "serial", "SKU", "page", "part no."), 32)
    filler = _pick(("the", "from", "with", "and the", "on", "version", "price", "about", "since"), 33)
    body = {
        ("phone", 1): _joined(tel, gap, _digits(3, 40), sep, _digits(3, 41), sep, _digits(4, 42)),
        ("phone", 2): _joined(tel, gap, "(0", _digits(2, 43), ") ", _digits(4, 44), " ", _digits(4, 45)),
        ("email", 1): _joined(_pick(("mail", "e-mail", "contact", "write to", "reach"), 46), gap, name, at, host, dot, top),
        ("email", 2): _joined(name, _pick(("[at]", " (at) ", " <at> "), 47), host, _pick(("[dot]", " (dot) "), 48), top),
        ("card", 1): _joined(_pick(("card", "Visa", "credit card", "payment"), 49), gap, groups[0], card_sep, groups[1], card_sep, groups[2], card_sep, groups[3]),
        ("ip", 1): _joined(_pick(("ip", "host", "server", "address"), 50), gap, octet[0], "[.]", octet[1], "[.]", octet[2], "[.]", octet[3]),
        ("ip", 2): _joined(_pick(("ip", "host", "gateway"), 51), gap, octet[0], " dot ", octet[1], " dot ", octet[2], " dot ", octet[3]),
        ("phone", -1): _joined(other, gap, _digits(3, 52), sep, _digits(3, 53), sep, _digits(4, 54)),
        ("phone", -2): _joined(filler, " ", "20", _digits(2, 55), "-", _digits(2, 56), "-", _digits(2, 57), " ", _digits(2, 58)),
        ("phone", -3): _joined(other, gap, "978-", _digits(1, 59), "-", _digits(2, 60), "-", _digits(5, 61), "-", _digits(2, 62)),
        ("phone", -4): _joined(filler, " ", _digits(2, 63), sep, _digits(3, 64), sep, _digits(3, 65)),
        ("email", -1): _joined(_pick(("meet", "look", "was", "stay", "work"), 66), " at ", _pick(("home", "noon", "school", "the"), 67), ".", _pick(("And", "He", "So", "It"), 68)),
        ("email", -2): _joined(_pick(("arrive", "stop", "look"), 69), " at ", host, " dot ", _pick(("matrix", "product", "and"), 70)),
        ("card", -1): _joined(other, gap, _digits(4, 71), card_sep, _digits(4, 72), card_sep, _digits(4, 73), card_sep, _digits(4, 74)),
        ("card", -2): _joined(filler, " ", _digits(4, 75), sep, _digits(4, 76), sep, _digits(4, 77), sep, _digits(4, 78)),
        ("ip", -1): _joined(other, gap, octet[0], " dot ", octet[1], " dot ", octet[2], " dot ", octet[3]),
        ("ip", -2): _joined(filler, " ", _digits(3, 79), "[.]", _digits(3, 80), "[.]", "9", _digits(2, 81), "[.]", _digits(3, 82)),
    }
    place = F.pmod(F.col("id"), F.lit(len(body)))
    text, kind, label = F.lit(None), F.lit(None), F.lit(None)
    for n, ((one, sign), value) in enumerate(body.items()):
        text, kind = F.when(place == n, value).otherwise(text), F.when(place == n, F.lit(one)).otherwise(kind)
        label = F.when(place == n, F.lit(float(sign > 0))).otherwise(label)
    return spark.range(rows).select("id", _joined("So it ", text, " then it").alias("text"), kind.alias("kind"), label.alias("label"))


def _boosted(rows: DataFrame) -> list:
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    learner = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.4, seed=SEED)
    model: GBTClassificationModel = learner.fit(assembled)
    return [(weight, _tree(tree._java_obj.rootNode())) for tree, weight in zip(model.trees, model.treeWeights, strict=True)]


def _tree(node) -> tuple | float:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (FEATURES[split.featureIndex()], float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def _value(tree: tuple | float, x: Column) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    name, threshold, left, right = tree
    return F.when(x[name] <= threshold, _value(left, x)).otherwise(_value(right, x))


def score(trees: list, x: Column) -> Column:
    """Probability of personal data, from the summed trees."""
    margin = reduce(lambda a, b: a + b, [F.lit(weight) * _value(tree, x) for weight, tree in trees])
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def proposals_of_texts(texts: DataFrame) -> DataFrame:
    """The longest proposal of the labelled kind in each labelled text, with its features."""
    df = _spans_of(texts).select("id", "kind", "label", F.explode("proposed").alias("p"))
    df = df.filter(F.col("p.kind") == F.col("kind"))
    longest = F.max_by("p", F.struct(F.col("p.end") - F.col("p.start"), -F.col("p.start")))
    return df.groupBy("id", "kind", "label").agg(longest.alias("p")).select("id", "kind", "label", "p.x.*")


def train(spark: SparkSession, rows: int = TRAINING_ROWS) -> Model:
    """Fits trees on three quarters of the labelled rows, thresholds on the rest."""
    table = stored(proposals_of_texts(labelled_texts(spark, rows)), "pii-training")
    held = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    trees = _boosted(table.filter(~held))
    scored = table.filter(held).select("kind", "label", score(trees, F.struct(*FEATURES)).alias("score"))
    bins = (
        scored.groupBy("kind", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
        .agg(F.sum("label").cast("int").alias("right"), F.count("*").alias("all"))
        .collect()  # at most four kinds times BINS rows
    )
    thresholds, calibrated, held_out = {}, {}, {}
    for kind in KINDS:
        counts = {b["bin"]: (b["right"], b["all"]) for b in bins if b["kind"] == kind}
        calibrated[kind] = isotonic([counts.get(n, (0, 0)) for n in range(BINS)])
        right = found = 0
        thresholds[kind], held_out[kind] = 2.0, (0, 0, sum(r for r, _ in counts.values()))
        for n in sorted(counts, reverse=True):
            right, found = right + counts[n][0], found + counts[n][1]
            if right >= PRECISION * found and n >= BINS // 2:
                thresholds[kind] = n / BINS
                held_out[kind] = (right, found, held_out[kind][2])
    return Model(trees, thresholds, calibrated, held_out)


def isotonic(counts: list[tuple[int, int]]) -> list[float]:
    """Shares of (right, all) by bin, made never falling by pooling neighbours; a bin without rows
    joins the bin below it, at the low end the one above."""
    pools: list[list[int]] = []  # right, all, bins
    for right, found in counts:
        pools.append([right, found, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            right, found, bins = pools.pop()
            pools[-1] = [pools[-1][0] + right, pools[-1][1] + found, pools[-1][2] + bins]
    return [right / found if found else 0.0 for right, found, bins in pools for _ in range(bins)]


# -- documents ----------------------------------------------------------------------------


def _accepted(model: Model) -> tuple[Column, Column]:
    """`good`, the proposals at their threshold or above, and of those that overlap the likeliest.

    Proposals of one kind never overlap. So all of one kind and probability are settled at once
    against what was accepted before, which is free of overlaps and sorted by start.
    """
    limit = F.create_map(*[F.lit(v) for kind in KINDS for v in (kind, model.thresholds[kind])])
    # the turn of a kind and score bin: likeliest first, then kinds as listed
    turns = F.create_map(
        *[
            v
            for place, kind in enumerate(KINDS)
            for v in (F.lit(kind), F.lit([round((1 - p) * 1e6) * len(KINDS) + place for p in model.calibrated[kind]]))
        ]
    )

    def scored(p: Column) -> Column:
        span = F.struct(p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind"))
        return F.struct(score(model.trees, p["x"]).alias("score"), span.alias("span"))

    def queued(p: Column) -> Column:
        place = F.least(F.floor(p["score"] * BINS), F.lit(BINS - 1)).cast("int")
        return F.struct(F.get(F.element_at(turns, p["span"]["kind"]), place).alias("turn"), p["span"].alias("span"))

    reached = F.filter(F.transform("proposed", scored), lambda p: p["score"] >= F.element_at(limit, p["span"]["kind"]))
    good = F.transform(reached, queued)

    def settle(out: Column, turn: Column) -> Column:
        next_ones = F.transform(F.filter("good", lambda p: p["turn"] == turn), lambda p: p["span"])
        return F.array_sort(F.concat(out, F.filter(next_ones, lambda s: ~_overlaps(s, out))))

    return good, F.aggregate(
        F.array_sort(F.array_distinct(F.transform("good", lambda p: p["turn"]))), F.array().cast(SPAN), settle
    )


def find_personal_data(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, text, base, spans) per row of `docs`: arrays of (kind, start, end), by kind as
    listed and then start; `spans` holds the base and the added ones."""
    model = model or train(docs.sparkSession)
    df = _spans_of(docs.select("doc_id", text_of().alias("text")))
    good, accepted = _accepted(model)
    df = opened(opened(df, good=good), accepted=accepted)
    added = F.transform(
        "accepted", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    df = opened(df, added=added)
    by_kind = [F.array_sort(F.concat(F.col(f"base_{kind}"), _of_kind("added", kind))) for kind in KINDS]
    return df.select("doc_id", "text", "base", *[F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS], F.concat(*by_kind).alias("spans"))


def redact(found: DataFrame) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets; of overlapping spans the
    first one is replaced and the others are cut to what lies behind it."""
    sorted_spans = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    df = opened(found.select("doc_id", "text", "spans"), ordered=sorted_spans, cells=_cells(F.col("text")))
    df = with_running(df, {"reached": F.transform("ordered", lambda s: s["end"])}, lambda a, b: F.greatest(a, b))

    def between(start: Column, end: Column) -> Column:
        first, last = F.floor(start / CELL).cast("int"), F.floor(end / CELL).cast("int")
        part = F.array_join(F.slice("cells", first + 1, last - first + 1), "")
        return F.substring(part, F.pmod(start, F.lit(CELL)) + 1, end - start)

    def piece(s: Column, i: Column) -> Column:
        at = F.when(i == 0, 0).otherwise(F.get("reached", i - 1))
        mark = F.concat(between(at, F.greatest(s["start"], at)), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["end"] <= at, "").otherwise(mark)

    end = F.when(F.size("ordered") == 0, 0).otherwise(F.get("reached", F.size("ordered") - 1))
    rest = between(end, F.char_length("text"))
    return df.select("doc_id", F.concat(F.array_join(F.transform("ordered", piece), ""), rest).alias("text"))
