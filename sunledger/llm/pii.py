"""Personal data: candidate spans, a boosted-tree score, calibrated thresholds, redaction.

Everything that touches text is a column expression. High-recall generators propose spans,
which may overlap: the four base kinds with their exact checks, and two loose kinds, runs of
digits with separators (``number``) and things written like an address (``handle``). A span's
place is read off the gaps between matches. Patterns begin where a run of their first class
begins or the last match ended, and their repetitions are possessive, so that a long run is
passed once.

Loose candidates are described by small whole numbers of format and context; what the base
rules go by (a leading ``+``, the sign for "at") is no feature. Only candidates that meet no
base span can be added, so the thresholds are set on those alone, and their target is not a
base match but ``evidence``: for a number, the length of a phone number, no date, and a word
for phones as the nearest word of a topic before it (an order number has its own words); for
a handle, a written-out "at" and a host name. Candidates that meet a base span are examples
too, as evident ones; their format shows what phones and addresses look like. One
aggregation over all documents counts each description, so training data are as many rows as
there are descriptions, whatever the corpus (``DESCRIPTIONS`` at most). Gradient boosting
fits trees of two levels on half of the candidates; on the other half the lowest threshold
is chosen that keeps the precision among the open ones. Trees become nested conditional
expressions, and loose candidates above the threshold that overlap no base span are added.

Defined cases: null text counts as empty; a text without candidates has no spans; without
any candidates the model adds nothing; spans are code points with an exclusive end.
"""

from __future__ import annotations

from math import exp, log, prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

# The base kinds in the order of their listing, as possessive patterns.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "number": r"(?:\G|(?<![0-9]))[+(]?+[0-9](?:[\x20().-]{0,2}+[0-9]){6,}+",
    "handle": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?\((?:at|AT)\)\x20?|\x20?\[(?:at|AT)\]\x20?)[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",
}
KINDS = [*BASE, *LOOSE]

#: What a text must hold for a pattern to be tried.
_NEEDS = {"email": "@", "handle": "@|[(\\[](at|AT)[)\\]]", "phone": "\\+[0-9]", "ip": "[0-9]\\.[0-9]"}

_SPANS = "array<struct<kind:string, start:int, stop:int, value:string>>"

#: Features (name, number of values) and words of context.
FEATURES = {
    "kind": 2, "digits": 7, "dots": 4, "zero": 2, "dated": 2, "spaced": 2, "dashed": 2, "written": 2, "joined": 2, "topic": 6
}
DESCRIPTIONS = prod(FEATURES.values())
CONTEXT = 24
#: Words of topics; the nearest before a candidate is its topic.
TOPICS = (
    "tel|telefon|telephone|phones?|call|called|calling|mobile?|handy|fax|telefax|dial|sms|whatsapp|cell",
    "card|visa|credit|iban|account",
    "e-?mail|mail|contact|write",
    "host|server|addr|address|ip",
    "orders?|ordered|invoice|ticket|ref|reference|id|item|part|sku|serial|case|article|isbn|issn|doi|version|date|code|tracking",
)
PHONE = 1
_TOPIC_WORDS = [rf"(?:{words})" for words in TOPICS]
_NEAREST = r"(?s).*(?<![a-z0-9])(" + "|".join(_TOPIC_WORDS) + r")(?![a-z])"
#: A written-out "at", and the name of a host.
_AT = r"[(\[](?:at|AT)[)\]]"
_HOST = r"\.[A-Za-z]{2,}$"
_DATE = r"^\(?(?:(?:19|20)[0-9]{2}[-.][0-9]{1,2}[-.][0-9]{1,2}|[0-9]{1,2}[-.][0-9]{1,2}[-.](?:19|20)[0-9]{2})(?![0-9])"

ROUNDS, STEP, RIDGE = 20, 0.3, 1.0
PRECISION = 0.95


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda's variable is a value, whereas
    a column that a lambda refers to is evaluated for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _proposed(text: Column, kind: str) -> Column:
    """Spans of the pattern's leftmost, non-overlapping matches."""
    pattern = (BASE | LOOSE)[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pieces = F.zip_with(found, gaps, lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))

    def step(state, piece):
        start = state["at"] + F.length(piece["gap"])
        stop = start + F.length(piece["value"])
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), piece["value"].alias("value")
        )
        # The last gap has no match after it.
        out = F.when(piece["value"].isNull(), state["out"]).otherwise(F.concat(state["out"], F.array(span)))
        return F.struct(F.coalesce(stop, state["at"]).alias("at"), out.alias("out"))

    spans = F.aggregate(pieces, begin, step, lambda s: s["out"])
    return F.when(text.rlike(_NEEDS.get(kind, "[0-9]")), spans).otherwise(F.array().cast(_SPANS))


def _luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits."""

    def step(state, digit):
        value = digit.cast("int")
        doubled = 2 * value - F.when(value > 4, 9).otherwise(0)
        total = state["total"] + F.when(state["odd"], value).otherwise(doubled)
        return F.struct(total.alias("total"), (~state["odd"]).alias("odd"))

    begin = F.struct(F.lit(0).alias("total"), F.lit(True).alias("odd"))
    return F.aggregate(F.split(F.reverse(digits), ""), begin, step, lambda s: s["total"] % 10 == 0)


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(0*+(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)(\.|$)){4}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return _let(digits, lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def _meets(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["stop"]) & (span["start"] < o["stop"]))


def _described(span: Column, before: Column, digits: Column, near: Column) -> Column:
    """The features of a loose candidate, as small whole numbers."""
    value = span["value"]
    handle = span["kind"] == "handle"
    topic = F.lit(0)
    for i, words in reversed(list(enumerate(_TOPIC_WORDS, start=1))):
        topic = F.when(near.rlike(f"^{words}$"), i).otherwise(topic)
    size = F.lit(0)
    for i, least in enumerate((7, 8, 10, 13, 16, 17), start=1):
        size = F.when(digits >= least, i).otherwise(size)
    host = F.when(handle, F.regexp_replace(value, rf"^.*(?:@|{_AT})", "")).otherwise(value)
    return F.struct(
        handle.cast("int").alias("kind"),
        size.alias("digits"),
        F.least(F.regexp_count(host, F.lit(r"\.")), F.lit(3)).alias("dots"),
        value.rlike(r"^\(?0").cast("int").alias("zero"),
        value.rlike(_DATE).cast("int").alias("dated"),
        (~handle & value.contains(" ")).cast("int").alias("spaced"),
        value.contains("-").cast("int").alias("dashed"),
        (handle & value.rlike(_HOST)).cast("int").alias("written"),
        before.rlike("[a-z0-9]$").cast("int").alias("joined"),
        topic.alias("topic"),
    )


def _evident(span: Column, x: Column, digits: Column) -> Column:
    """Whether a candidate that meets no base span is personal data by form and context."""
    phone = digits.between(7, 15) & (x["dated"] == 0) & (x["joined"] == 0) & (x["topic"] == PHONE)
    address = (x["written"] == 1) & span["value"].rlike(_AT)
    return F.when(span["kind"] == "handle", address).otherwise(phone)


def candidates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, text, base (checked spans) and loose (spans with features, ``sure``: whether
    they meet a base span, and ``evident``) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col(key), text.alias("text"))

    def checked_spans(kind):
        return F.filter(_proposed(F.col("text"), kind), lambda s: _holds(kind, s["value"]))

    checked = [checked_spans(k) for k in BASE]
    rows = rows.withColumn("base", F.concat(*checked))
    loose = F.concat(*[_proposed(F.col("text"), k) for k in LOOSE])

    def describe(text, base, span):
        before = F.substring(text, F.greatest(span["start"] - CONTEXT + 1, F.lit(1)), F.least(span["start"], F.lit(CONTEXT)))
        digits = F.length(F.regexp_replace(span["value"], "[^0-9]", ""))
        known = F.struct(F.lower(before).alias("before"), digits.alias("digits"))

        def judged(k):
            near = F.regexp_extract(k["before"], _NEAREST, 1)
            x = _let(near, lambda word: _described(span, k["before"], k["digits"], word))
            sure = _meets(span, base)
            evident = lambda x: sure | _evident(span, x, k["digits"])
            return _let(x, lambda x: F.struct(span.alias("span"), sure.alias("sure"), evident(x).alias("evident"), x.alias("x")))

        return _let(known, judged)

    whole = F.struct(F.col("text").alias("t"), F.col("base").alias("b"), loose.alias("l"))
    described = _let(whole, lambda w: F.transform(w["l"], lambda span: describe(w["t"], w["b"], span)))
    return rows.withColumn("loose", described)


# ---- model ------------------------------------------------------------------------


def _logistic(x: float) -> float:
    return 1 / (1 + exp(-max(-30.0, min(30.0, x))))


def _best_split(rows: list, names: list[str]):
    """(gain, feature, last value on the left) for rows of (x, gradient, hessian)."""
    best = (1e-6, None, 0)
    total_g, total_h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    for name in names:
        for cut in range(FEATURES[name] - 1):
            g = sum(r[1] for r in rows if r[0][name] <= cut)
            h = sum(r[2] for r in rows if r[0][name] <= cut)
            gain = g * g / (h + RIDGE) + (total_g - g) ** 2 / (total_h - h + RIDGE) - total_g**2 / (total_h + RIDGE)
            if gain > best[0]:
                best = (gain, name, cut)
    return best


def _tree(rows: list, depth: int):
    """A leaf value, or (feature, cut, left, right)."""
    leaf = STEP * sum(r[1] for r in rows) / (sum(r[2] for r in rows) + RIDGE)
    if not depth:
        return leaf
    _, name, cut = _best_split(rows, list(FEATURES))
    if name is None:
        return leaf
    sides = [[r for r in rows if (r[0][name] <= cut) == left] for left in (True, False)]
    return (name, cut, _tree(sides[0], depth - 1), _tree(sides[1], depth - 1))


def _value(tree, x: dict[str, int]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


class Model:
    """Boosted trees over descriptions; ``threshold`` per loose kind, or None to add nothing."""

    def __init__(self, start: float, trees: list, thresholds: dict[int, float]):
        self.start, self.trees, self.thresholds = start, trees, thresholds

    def raw(self, x: dict[str, int]) -> float:
        return self.start + sum(_value(t, x) for t in self.trees)

    def accepts(self, x: Column) -> Column:
        """Whether a described candidate is above its kind's threshold."""

        def column(tree):
            if isinstance(tree, tuple):
                name, cut, left, right = tree
                return F.when(x[name] <= cut, column(left)).otherwise(column(right))
            return F.lit(float(tree))

        if not self.thresholds:
            return F.lit(False)
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + column(tree)
        out = F.lit(False)
        for kind, least in self.thresholds.items():
            out = F.when(x["kind"] == kind, total >= least).otherwise(out)
        return out


def train(counts: list[tuple[dict[str, int], int, int, int, int]]) -> Model:
    """Fit on descriptions (x, fold, sure, evident, others): candidates that meet a base span,
    and of those that do not, the ones with evidence and the others."""
    fit = [(x, f, s + p, n) for x, f, s, p, n in counts if f == 0]
    good, bad = sum(c[2] for c in fit), sum(c[3] for c in fit)
    if not good:
        return Model(0.0, [], {})
    model = Model(log((good + RIDGE) / (bad + RIDGE)), [], {})
    raw = [model.start] * len(fit)
    for _ in range(ROUNDS):
        rows = []
        for (x, _, p, n), r in zip(fit, raw, strict=True):
            chance = _logistic(r)
            rows.append((x, p - (p + n) * chance, (p + n) * chance * (1 - chance)))
        tree = _tree(rows, 2)
        model.trees.append(tree)
        raw = [r + _value(tree, c[0]) for r, c in zip(raw, fit, strict=True)]
    for kind in range(FEATURES["kind"]):
        open_ = [(model.raw(x), p, n) for x, f, _, p, n in counts if f == 1 and x["kind"] == kind and p + n]
        ranked = sorted(open_, key=lambda c: -c[0])
        good = bad = 0
        for i, (score, p, n) in enumerate(ranked):
            good, bad = good + p, bad + n
            last = i + 1 == len(ranked) or ranked[i + 1][0] < score
            if last and good and good >= PRECISION * (good + bad):
                model.thresholds[kind] = score
    return model


def fit(docs: DataFrame) -> Model:
    found = candidates(docs.select("text").withColumn("_key", F.lit(0)), "_key")
    each = found.select(F.explode("loose").alias("c")).select(
        "c.x.*", "c.sure", "c.evident", (F.pmod(F.xxhash64("c.span.value"), F.lit(2))).cast("int").alias("fold")
    )
    rows = (
        each.groupBy(*FEATURES, "fold")
        .agg(
            F.count_if("sure").alias("s"),
            F.count_if(F.col("evident") & ~F.col("sure")).alias("p"),
            F.count_if(~F.col("evident")).alias("n"),
        )
        .orderBy(*FEATURES, "fold")
        .collect()  # DESCRIPTIONS * 2 rows at most
    )
    return train([({k: r[k] for k in FEATURES}, r["fold"], r["s"], r["p"], r["n"]) for r in rows])


# ---- operator ---------------------------------------------------------------------


def detect(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """key, text, base and spans (base and added), by kind and start."""
    found = candidates(docs, key)
    added = F.filter("loose", lambda c: ~c["sure"] & model.accepts(c["x"]))
    plain = F.transform(added, lambda c: c["span"])
    return found.select(key, "text", "base", F.concat("base", plain).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def digest(found: DataFrame) -> DataFrame:
    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(k) for k in BASE],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return digest(detect(docs, fit(docs)))


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; overlapping spans are one.

    ``n_chars``, if there, is the new text's length; a null text stays null.
    """
    whole = docs.withColumn("_row", F.struct(*[F.col(c) for c in docs.columns]))
    found = detect(whole, model, "_row")
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], s["stop"], s["kind"])))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def step(state, span):
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        out = F.concat(state["out"], gap, F.lit("["), F.upper(span["kind"]), F.lit("]"))
        apart = span["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], span["stop"]).alias("at"), F.when(apart, out).otherwise(state["out"]).alias("out")
        )

    clean = F.aggregate(
        ordered, begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    new = F.when(F.col("_row.text").isNotNull(), F.when(F.size("spans") > 0, clean).otherwise(text))
    rows = found.withColumn("_new", new)
    columns = {"text": F.col("_new"), "n_chars": F.length("_new").cast("long")}
    return rows.select(*[columns.get(c, F.col(f"_row.{c}")).alias(c) for c in docs.columns])
