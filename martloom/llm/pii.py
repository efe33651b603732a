"""Personal data: recall-oriented candidates scored by boosted trees, in DataFrame functions only.

Patterns propose spans, those of the four base rules and wider ones that overlap them. Format
and context of a candidate are a few small numbers. Candidates that the base rules confirm are
the positive examples, the others the negative ones; as the features have few values, the
whole corpus is counted into a table of feature combinations, on which the trees are grown.
The trees become one SQL expression. A threshold per kind, set on the counted scores, selects
the wider candidates that are redacted besides the base spans.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.common import text_of
from martloom.session import stage

# The kinds in the order of the digest.
KINDS = ("email", "ip", "card", "phone")
# The base rules; possessive repeats and look-behind keep them linear without changing a match.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider rules of the same kinds: masked signs, other separators, no country code.
WIDE = {
    "email": r"(?i)(?:(?<![a-z0-9._%+-])|\G)[a-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]| at )\x20?[a-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]| dot )\x20?[a-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\])[0-9]{1,3}){3}(?![0-9.]*[0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,2}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:00[0-9]{1,2}[\x20.-]?)?\(?[0-9]{3}\)?[\x20./-]{1,2}[0-9]{3}[\x20./-][0-9]{4}(?![0-9])",
}
# What a text must have for a rule to be tried.
NEEDS = {"email": r"(?i)@|[(\[ ]at[)\] ]", "ip": r"[0-9]\.|\[\.\]", "card": "[0-9]{2}|[0-9][ -][0-9]", "phone": r"[0-9]{3}|\+[0-9]"}
WORDS = r"(?i)(?:mail|e-?mail|contact|kontakt|phone|tel|call|fax|mobile|card|visa|konto|pay|ip|host|server|address)[\p{L}]*[\s:.=#-]*(?:\+?[0-9]{1,3}[\s.-]?)?$"
CONTEXT = 24
ROUNDS = 24
RATE = 0.3
PRECISION = 0.95  # of confirmed candidates at the threshold and above
LEAST = 0.5  # and the score there


def spans_of(text: Column, pattern: str, need: str) -> Column:
    """Matches, leftmost and non-overlapping: characters since the match before, match, text around."""
    gaps, found = F.split(text, pattern), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.arrays_zip(gaps.alias("gap"), found.alias("match"), F.slice(gaps, F.lit(2), F.size(gaps)).alias("rest"))
    made = F.transform(
        F.filter(zipped, lambda x: x["match"].isNotNull()),
        lambda x: F.struct(
            F.char_length(x["gap"]).cast("long").alias("gap"),
            x["match"].alias("match"),
            F.right(x["gap"], F.lit(CONTEXT)).alias("before"),
            F.left(x["rest"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return F.when(text.rlike(need), made)


def luhn(digits: Column) -> Column:
    """Whether the checksum of a digit string holds: every second digit from the right is doubled."""
    last = F.reverse(digits)
    plain = F.regexp_replace(last, "(.).?", "$1")
    doubled = F.translate(F.regexp_replace(last, ".(.?)", "$1"), "0123456789", "0246813579")
    total = F.aggregate(F.split(F.concat(plain, doubled), ""), F.lit(0), lambda acc, d: acc + F.coalesce(F.try_to_number(d, F.lit("9")).cast("int"), F.lit(0)))
    return total % 10 == 0


def confirmed(kind: Column, match: Column) -> Column:
    """Whether a match of a base rule stands: parts of an address up to 255, digits of a card and of a phone."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(False))
        .otherwise(n.between(8, 15))
    )


# Features and their numbers of values; a kind has at most their product of combinations.
FEATURES = {"f_digits": 8, "f_marks": 4, "f_plus": 2, "f_word": 2, "f_before": 3, "f_after": 3, "f_end": 4}


def with_features(rows: DataFrame) -> DataFrame:
    """Format and context of a candidate as small numbers."""
    m = F.col("match")
    n = F.length(F.regexp_replace(m, "[^0-9]", ""))
    digits = reduce(lambda a, b: a + (n >= b).cast("int"), (1, 4, 8, 10, 12, 16, 20), F.lit(0))
    marks = F.when(m.rlike(r"[\[\]()_/]| at | dot "), 3).when(m.rlike("[.-]"), 2).when(m.rlike(" "), 1).otherwise(0)
    side = lambda c: F.when(F.col(c).isNull() | c_blank(c), 0).when(c_letter(c), 1).otherwise(2)
    c_blank = lambda c: F.col(c).rlike(r"^\s*$") | (F.col(c).rlike(r"\s$") if c == "before" else F.col(c).rlike(r"^[\s.,;:!?)]"))
    c_letter = lambda c: F.col(c).rlike(r"\p{L}$" if c == "before" else r"^\p{L}")
    end = F.length(F.regexp_extract(m, "([A-Za-z]*)$", 1))
    return rows.withColumns(
        {
            "f_digits": digits,
            "f_marks": marks,
            "f_plus": m.startswith("+").cast("int"),
            "f_word": F.coalesce(F.col("before").rlike(WORDS), F.lit(False)).cast("int"),
            "f_before": side("before"),
            "f_after": side("after"),
            "f_end": F.when(end == 0, 0).when(end == 1, 1).when(end <= 4, 2).otherwise(3),
        }
    )


def boost(table: list[dict], rounds: int = ROUNDS, rate: float = RATE) -> tuple[float, list[tuple]]:
    """Trees of two levels on counted combinations, by Newton steps of the logistic loss.

    ``table`` has the features, n and positive of every combination. A tree is (feature, cut,
    two leaves or cuts): ((f, c), (f1, c1, low, high), (f2, c2, low, high)); values below a cut
    go to the first branch.
    """
    total, good = sum(r["n"] for r in table), sum(r["positive"] for r in table)
    start = math.log((good + 1) / (total - good + 1))
    scores = [start] * len(table)
    trees: list[tuple] = []

    def best_cut(rows: list[int], grads: list[tuple[float, float]]):
        """Gain, feature, cut and the leaves of the best split of some rows."""
        g0, h0 = sum(grads[i][0] for i in rows), sum(grads[i][1] for i in rows)
        best = (0.0, "f_digits", 0, g0 / (h0 + 1), g0 / (h0 + 1))
        for name, values in FEATURES.items():
            at = [[0.0, 0.0] for _ in range(values)]
            for i in rows:
                at[table[i][name]][0] += grads[i][0]
                at[table[i][name]][1] += grads[i][1]
            g = h = 0.0
            for cut in range(1, values):
                g += at[cut - 1][0]
                h += at[cut - 1][1]
                gain = g * g / (h + 1) + (g0 - g) ** 2 / (h0 - h + 1) - g0 * g0 / (h0 + 1)
                if gain > best[0] + 1e-9:
                    best = (gain, name, cut, g / (h + 1), (g0 - g) / (h0 - h + 1))
        return best

    for _ in range(rounds if table else 0):
        grads = []
        for r, s in zip(table, scores):
            p = 1 / (1 + math.exp(-s))
            grads.append((r["positive"] - r["n"] * p, r["n"] * p * (1 - p)))
        rows = list(range(len(table)))
        gain, name, cut, *_ = best_cut(rows, grads)
        if not gain:
            break
        leaves = []
        for part in ([i for i in rows if table[i][name] < cut], [i for i in rows if table[i][name] >= cut]):
            _, below, at, low, high = best_cut(part, grads)
            leaves.append((below, at, rate * low, rate * high))
            for i in part:
                scores[i] += rate * (low if table[i][below] < at else high)
        trees.append((name, cut, *leaves))
    return start, trees


def tree_score(start: float, trees: list[tuple], value) -> float | Column:
    """The sum of the trees; ``value`` gives a feature, as a number or a column."""

    def pick(name, cut, low, high):
        test = value(name) < cut
        return F.when(test, low).otherwise(high) if isinstance(test, Column) else (low if test else high)

    total = F.lit(start) if isinstance(value("f_digits"), Column) else start
    for name, cut, first, second in trees:
        test = value(name) < cut
        if isinstance(test, Column):
            total = total + F.when(test, pick(*first)).otherwise(pick(*second))
        else:
            total = total + (pick(*first) if test else pick(*second))
    return total


def threshold(table: list[dict], start: float, trees: list[tuple]) -> float:
    """The lowest score from which on the counted candidates have PRECISION, LEAST at least."""
    scored = sorted(((tree_score(start, trees, r.get), r["n"], r["positive"]) for r in table), reverse=True)
    floor, best, n, good = math.log(LEAST / (1 - LEAST)), math.inf, 0, 0
    for k, (score, count, positive) in enumerate(scored):
        n, good = n + count, good + positive
        last_of_score = k + 1 == len(scored) or scored[k + 1][0] < score
        if last_of_score and score >= floor and good >= PRECISION * n:
            best = score
    return best


def candidates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored: a number and the id of every document, and the matches of all rules, base rules first."""
    text = text_of(text_col)
    rules = [spans_of(text, rule[kind], NEEDS[kind]) for rule in (BASE, WIDE) for kind in KINDS]
    return stage(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.array(*rules).alias("rules")), "candidates")


def placed(found: DataFrame) -> DataFrame:
    """One row per candidate: row, rule, kind, base, start, stop (code points), match and context."""
    each = found.select("row", F.posexplode("rules").alias("rule", "spans")).filter("spans IS NOT NULL")
    each = each.select("row", "rule", F.posexplode("spans").alias("place", "s")).select("row", "rule", "place", "s.*")
    size = F.char_length("match")
    upto = F.sum(F.col("gap") + size).over(Window.partitionBy("row", "rule").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return (
        each.withColumn("stop", upto.cast("long"))
        .withColumn("start", F.col("stop") - size)
        .withColumn("kind", F.element_at(kinds, (F.col("rule") % len(KINDS) + 1).cast("int")))
        .withColumn("base", F.col("rule") < len(KINDS))
    )


def train(wide: DataFrame) -> dict[str, tuple]:
    """Start, trees and threshold of each kind; ``wide`` has kind, features and whether a base rule confirms.

    The driver gets one row per combination of feature values: a few thousand at most, by FEATURES.
    """
    counted = wide.groupBy("kind", *FEATURES).agg(F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("positive"))
    rows = [r.asDict() for r in counted.orderBy("kind", *FEATURES).collect()]
    models = {}
    for kind in KINDS:
        table = [r for r in rows if r["kind"] == kind]
        start, trees = boost(table)
        models[kind] = (start, trees, threshold(table, start, trees) if table else math.inf)
    return models


def select_added(wide: DataFrame, models: dict[str, tuple]) -> DataFrame:
    """Candidates that no base span overlaps and whose score reaches the threshold of their kind."""
    score, least = F.lit(None).cast("double"), F.lit(None).cast("double")
    for kind, (start, trees, cut) in models.items():
        score = F.when(F.col("kind") == kind, tree_score(start, trees, F.col)).otherwise(score)
        least = F.when(F.col("kind") == kind, F.lit(float(cut))).otherwise(least)
    return wide.filter(~F.col("good")).withColumn("score", score).filter(F.col("score") >= least)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its personal data.

    The base spans of each kind are the leftmost non-overlapping matches of its rule that
    ``confirmed`` keeps; the trees add wider candidates that overlap none of them. Offsets are
    code points, the end exclusive. A null or empty text has no spans; repeated rows are treated
    one by one; an empty table gives no rows; other columns are not read. Columns: id_col,
    n_email, n_ip, n_card, n_phone (base spans), base_spans and all_spans (arrays of kind number,
    start, stop in this order).
    """
    found = candidates(docs, id_col, text_col)
    rows = stage(placed(found).withColumn("good", F.col("base") & confirmed(F.col("kind"), F.col("match"))), "candidate-spans")
    # a wide candidate is confirmed if a confirmed base span of its kind overlaps it: the last to
    # start before its end ends behind its start (base spans of a kind do not overlap)
    window = Window.partitionBy("row", "kind").orderBy("point", "order").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.filter("base AND good").select("row", "kind", F.col("start").alias("point"), F.lit(1).alias("order"), F.col("stop").alias("until"))
    wide = rows.filter("NOT base").drop("good", "base")
    asked = wide.select("*", F.col("stop").alias("point"), F.lit(0).alias("order"), F.lit(None).cast("long").alias("until"))
    known = asked.unionByName(ends, allowMissingColumns=True).withColumn("reach", F.max("until").over(window))
    known = known.filter("order = 0").withColumn("good", F.coalesce(F.col("reach") > F.col("start"), F.lit(False)))
    wide = stage(with_features(known).select("row", "kind", "start", "stop", "good", *FEATURES), "wide-candidates")
    added = select_added(wide, train(wide))

    number = F.array_position(F.array(*[F.lit(kind) for kind in KINDS]), F.col("kind")).cast("int")
    span = F.struct(number.alias("kind"), "start", "stop").alias("span")
    base = rows.filter("base AND good").select("row", span, F.lit(True).alias("base"))
    spans = base.union(added.select("row", span, F.lit(False).alias("base")))
    listed = spans.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), F.col("span")))).alias("base_spans"),
        F.array_sort(F.array_distinct(F.collect_list("span"))).alias("all_spans"),
    )
    none = F.array().cast("array<struct<kind:int,start:bigint,stop:bigint>>")
    out = found.select("row", "id").join(listed, "row", "left").select(
        F.col("id").alias(id_col), F.coalesce("base_spans", none).alias("base_spans"), F.coalesce("all_spans", none).alias("all_spans")
    )
    kinds = F.transform("base_spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k + 1))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return out.select(id_col, *counts, "base_spans", "all_spans")


def spelled(spans: str) -> Column:
    """kind:start:stop of an array of spans, joined by commas."""
    kinds = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")

