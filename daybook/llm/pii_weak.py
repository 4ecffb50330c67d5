"""Personal data by weak-supervision aggregation. DataFrame functions only.

Patterns propose spans, labelers of three sorts (regex, gazetteer, context) vote on them or abstain,
expectation-maximisation estimates how reliable each labeler is without any true label, and a
logistic classifier is trained on the resulting beliefs. It decides on the spans that the base rules
do not cover.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.llm.stage import ROW, Numbered, cut, numbered

#: Fixed values of the contract: kinds in order, and their patterns. Where a run of characters can
#: only match from its first one on, a look behind says so, and what cannot help by giving
#: characters back is possessive; both change only the time that long runs take.
BASE = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # What the base rules leave out.
    "spelled_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]++|\.[A-Za-z0-9-]++)++",
    "local_phone": r"(?<![0-9+(])\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])",
    "secret": r"(?i)(?:token|secret|password|passwd|api[_-]?key)\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_-]{16,}+[\"']?",
}
#: Characters without which a pattern cannot match.
NEEDS = {"email": "@", "phone": "+", "ip": "."}
KINDS = list(PATTERNS)
#: The name under which a span is reported.
NAMES = ["email", "ip", "card", "phone", "email", "phone", "secret"]
ORDER = {name: number for number, name in enumerate([*BASE, "secret"])}

#: Characters of context that a span carries along.
CONTEXT = 40

#: Gazetteers (fixed values).
CUES = (
    "tel", "phone", "call", "fax", "mobile", "contact", "mail", "card", "visa", "account", "address",
    "token", "secret", "password", "login", "user", "konto", "karte", "telefon", "handy", "kontakt",
    "carte", "compte", "appel", "tarjeta", "cuenta", "correo", "llame",
)
COUNTER_CUES = (
    "version", "license", "licence", "licensed", "isbn", "page", "chapter", "section", "figure",
    "table", "rfc", "http", "total", "price", "seite", "kapitel", "chapitre", "capítulo",
)
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "eu")

ROUNDS = 40


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def one(i):
        d = F.try_to_number(F.substr(back, i, F.lit(1)), F.lit("9")).cast("int")
        return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(F.transform(places, one), F.lit(0), lambda a, b: a + b) % 10 == 0


def _small(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) <= 2) | ((F.length(short) == 3) & (short <= "255"))


def valid(kind: Column, text: Column) -> Column:
    """Whether a match of a base pattern passes the rule of its kind."""
    digits = _digits(text)
    n = F.length(digits)
    return (
        F.when(kind == KINDS.index("email"), True)
        .when(kind == KINDS.index("ip"), F.forall(F.split(text, r"\."), _small))
        .when(kind == KINDS.index("card"), F.when(n.between(12, 19), _luhn(digits)).otherwise(False))
        .when(kind == KINDS.index("phone"), n.between(9, 15))
        .otherwise(False)
    )


def spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Every match of every pattern: ``ROW, kind, start, end, match, before, after``, places in code
    points, end exclusive.

    Splitting at a pattern gives what lies between its matches, so the running sum of lengths gives
    their places in one pass over a text.
    """
    arrays = [ROW]
    for number, kind in enumerate(KINDS):
        here = F.contains(F.col(text), F.lit(NEEDS[kind])) if kind in NEEDS else F.col(text).rlike("[0-9]")
        if kind in ("spelled_email", "secret"):
            here = F.lower(F.col(text)).rlike(r"[\[(]at[\])]" if kind == "spelled_email" else "[=:]")
        found = F.regexp_extract_all(F.col(text), F.lit(PATTERNS[kind]), F.lit(0))
        arrays.append(F.when(here, found).alias(f"found{number}"))
        arrays.append(F.when(here, F.split(F.col(text), PATTERNS[kind], -1)).alias(f"rest{number}"))
    split = df.select(*arrays)

    def listed(number):
        rest = F.col(f"rest{number}")

        def one(match, i):
            return F.struct(
                F.lit(number).alias("kind"),
                i.alias("place"),
                F.length(rest[i]).alias("gap"),
                match.alias("match"),
                F.right(rest[i], F.lit(CONTEXT)).alias("before"),
                F.left(rest[i + 1], F.lit(CONTEXT)).alias("after"),
            )

        return F.coalesce(F.transform(f"found{number}", one), F.array())

    every = split.select(ROW, F.explode(F.concat(*map(listed, range(len(KINDS))))).alias("s")).select(ROW, "s.*")
    upto = W.partitionBy(ROW, "kind").orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    length = F.length("match")
    return every.withColumn("end", F.sum(F.col("gap") + length).over(upto)).select(
        ROW, "kind", (F.col("end") - length).alias("start"), "end", "match", "before", "after"
    )


def _is(kind: str) -> Column:
    return F.col("kind") == KINDS.index(kind)


def votes() -> dict[str, Column]:
    """Labelers: 1 personal, -1 not, 0 no opinion."""
    match, digits = F.col("match"), _digits(F.col("match"))
    before, after = F.lower("before"), F.col("after")
    cue = before.rlike(rf"(?:{'|'.join(CUES)})[^\n]{{0,20}}$")
    counter = before.rlike(rf"(?:{'|'.join(COUNTER_CUES)})[^\n]{{0,20}}$")
    numeric = _is("ip") | _is("card") | _is("phone") | _is("local_phone")
    different = F.length(F.regexp_replace(digits, r"(.)(?=.*\1)", ""))
    glued = F.col("before").rlike(r"[\p{L}\p{N}]$") | after.rlike(r"^[\p{L}\p{N}]")
    alone = F.col("before").rlike(r"(?:^|[\s(<\[\"'|])$") & after.rlike(r"^(?:$|[\s)>\].,;:!?\"'|#$%&*])")
    kind_rule = (
        F.when(_is("email"), F.when(match.rlike(rf"(?i)\.(?:{'|'.join(DOMAINS)})$"), 1).otherwise(-1))
        .when(_is("ip"), F.when(match.rlike(r"^(?:0|10|127|255)\.|^192\.168\."), -1).otherwise(1))
        .when(_is("card"), F.when(digits.rlike("^[3-6]"), 1).otherwise(-1))
        .when(_is("phone"), F.when(digits.rlike("^[1-9]"), 1).otherwise(-1))
        .when(_is("local_phone"), F.when(F.length(digits).between(9, 11), 1).otherwise(-1))
        .when(_is("secret"), F.when(match.rlike("[0-9].*[0-9].*[0-9]"), 1).otherwise(-1))
        .otherwise(0)
    )
    strict = F.when(F.col("kind") < len(BASE), F.when(F.col("valid"), 1).otherwise(-1)).otherwise(0)
    return {
        "strict": strict,
        "kind_rule": kind_rule,
        "cue": F.when(cue, 1).otherwise(0),
        "counter": F.when(counter, -1).otherwise(0),
        "variety": F.when(numeric, F.when(different >= 4, 1).otherwise(-1)).otherwise(0),
        "edges": F.when(glued, -1).when(alone, 1).otherwise(0),
    }


LABELERS = ["strict", "kind_rule", "cue", "counter", "variety", "edges"]
#: What the classifier sees beside the votes; small whole numbers.
EXTRA = ["size", "kind"]


def believe(patterns: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Dawid and Skene's expectation-maximisation over vote patterns (rows, values -1, 0, 1) with
    their counts. Gives the belief that each pattern is personal, and per labeler and class how
    often it votes -1, 0, 1. It starts from the majority, so that labelers are taken to be right more
    often than not, and keeps one vote of each sort in reserve."""
    belief = 1 / (1 + np.exp(-patterns.sum(1).astype(float)))
    table = np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        for side, share in enumerate((1 - belief, belief)):
            for value in (-1, 0, 1):
                table[side, :, value + 1] = ((patterns == value) * (share * weight)[:, None]).sum(0) + 1
        table /= table.sum(2, keepdims=True)
        prior = (belief @ weight + 1) / (weight.sum() + 2)
        logs = np.log(table)
        column = np.arange(patterns.shape[1])
        like = [logs[side][column, patterns + 1].sum(1) for side in (0, 1)]
        odds = like[1] - like[0] + math.log(prior / (1 - prior))
        belief = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return belief, table


def train(features: np.ndarray, belief: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method; the first feature is constant."""
    w = np.zeros(features.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        slope = features.T @ (weight * (p - belief)) + ridge * w
        curve = (features * (weight * p * (1 - p))[:, None]).T @ features + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _features(patterns: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Constant, votes for and votes against by labeler, size classes, kinds."""
    size, kind = extra[:, 0], extra[:, 1]
    return np.concatenate(
        [
            np.ones((len(patterns), 1)),
            patterns == 1,
            patterns == -1,
            size[:, None] == np.arange(1, 4),
            kind[:, None] == np.arange(1, len(KINDS)),
        ],
        axis=1,
    ).astype(float)


def classifier(candidates: DataFrame) -> Column | None:
    """Fit on all candidates, and give the log odds that a candidate is personal, as an expression.

    Only counts of patterns come to the driver: at most 3^6 votes, 4 sizes and 7 kinds.
    """
    counts = candidates.groupBy(*LABELERS, *EXTRA).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        return None
    counts.sort(key=tuple)
    table = np.array([tuple(r) for r in counts], dtype=np.int64)
    patterns, extra, n = table[:, : len(LABELERS)], table[:, len(LABELERS) : -1], table[:, -1].astype(float)
    belief, _ = believe(patterns, n)
    w = [float(x) for x in train(_features(patterns, extra), belief, n)]
    terms = [F.lit(w[0])]
    flags: Sequence[Column] = [
        *(F.col(c) == 1 for c in LABELERS),
        *(F.col(c) == -1 for c in LABELERS),
        *(F.col("size") == i for i in range(1, 4)),
        *(F.col("kind") == i for i in range(1, len(KINDS))),
    ]
    terms += [F.when(flag, weight).otherwise(0.0) for flag, weight in zip(flags, w[1:])]
    return sum(terms[1:], terms[0])


def find_personal_data(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Spans of personal data: ``ROW, kind, start, end, match, base``. ``base`` spans come from the
    fixed rules alone, all of them; the others are spans of further patterns that the classifier
    believes in and that touch no base span and no earlier span. Null texts have none."""
    texts = numbered(df, F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = spans(texts).withColumn("valid", valid(F.col("kind"), F.col("match")))
    length = F.length("match")
    size = F.when(length < 10, 0).when(length < 16, 1).when(length < 32, 2).otherwise(3)
    found = found.withColumns({**votes(), "size": size})
    found = cut(found.drop("before", "after"), "spans")
    score = classifier(found)
    found = found.withColumn("score", F.lit(0.0) if score is None else score)
    base = found.filter("valid").withColumn("base", F.lit(True))
    more = found.filter((F.col("kind") >= len(BASE)) & (F.col("score") >= 0)).withColumn("base", F.lit(False))
    every = base.unionByName(more).select(ROW, "kind", "start", "end", "match", "base")
    by_start = W.partitionBy(ROW).orderBy("start")
    until = F.max(F.when(F.col("base"), F.col("end"))).over(by_start.rangeBetween(W.unboundedPreceding, 0))
    since = F.min(F.when(F.col("base"), F.col("start"))).over(by_start.rangeBetween(0, W.unboundedFollowing))
    free = (F.coalesce(until, F.lit(0)) <= F.col("start")) & (F.coalesce(since, F.col("end")) >= F.col("end"))
    every = every.withColumn("free", F.col("base") | free).filter("free").drop("free")
    earlier = W.partitionBy(ROW).orderBy("start", "kind").rowsBetween(W.unboundedPreceding, -1)
    last = F.max(F.when(~F.col("base"), F.col("end"))).over(earlier)
    every = every.withColumn("last", last).filter(F.col("base") | F.col("last").isNull() | (F.col("last") <= F.col("start")))
    names = F.element_at(F.array(*map(F.lit, NAMES)), F.col("kind") + 1)
    return every.select(ROW, names.alias("kind"), "start", "end", "match", "base")


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, counts of base spans ``n_email, n_ip, n_card, n_phone``,
    ``base_sha256`` of the list of base spans, the list ``spans`` of all, and the row's number.

    A list names ``kind:start:end`` in order of start, then kind. Null and empty texts have empty
    lists. An empty table gives an empty result.
    """
    rows = numbered(df, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = find_personal_data(Numbered(rows))
    rank = F.create_map(*[F.lit(x) for pair in ORDER.items() for x in pair])[F.col("kind")]
    entry = F.struct("start", rank.alias("rank"), "end", F.concat_ws(":", "kind", "start", "end").alias("name"), "base")
    lists = found.groupBy(ROW).agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in BASE],
        F.sort_array(F.collect_list(entry)).alias("list"),
    )
    rows = rows.select("doc_id", ROW).join(lists, ROW, "left")
    listed = F.coalesce(F.col("list"), F.array().cast(lists.schema["list"].dataType))
    only_base = F.array_join(F.transform(F.filter(listed, lambda s: s["base"]), lambda s: s["name"]), ",")
    return rows.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.sha2(only_base.cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform(listed, lambda s: s["name"]), ",").alias("spans"),
        ROW,
    )
