"""Matching of two tables without a common key: MinHash sketches of attributes, pair features, a calibrated classifier."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Values kept of a claim's sketch and of a bill's: those of a set of at most this size are all kept.
SKETCH, BILL_SKETCH = 24, 48

#: Parts of the claims, by hash: what is learned of one is learned from the others, and calibrated on all of them.
FOLDS = 4

#: Confidences that are tried as the least one to accept, from the highest down, and how many claims make a step tell.
STEPS, TELLING = tuple(round(0.95 - 0.05 * i, 2) for i in range(10)), 20


def sketches(rows: DataFrame, key: str, elements: Column, size: int = SKETCH) -> DataFrame:
    """(key, value, n): bottom-k MinHash sketch of a record's set of elements, the `size` least hashes of it, and how many
    values the sketch has. Nulls are no element."""
    hashes = F.transform(F.array_compact(elements), lambda e: F.xxhash64(e))
    sketch = rows.select(F.col(key), F.slice(F.array_sort(F.array_distinct(hashes)), 1, size).alias("s"))
    return sketch.select(key, F.explode("s").alias("value"), F.size("s").alias("n"))


def candidates(left: DataFrame, right: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, alike): pairs of records that share a value of their sketches, each once, with the Jaccard similarity of their
    sets as the sketches estimate it: shared values over those of both. Skewed values are split by the engine at run time."""
    both = left.withColumnRenamed("n", "__x").join(right.withColumnRenamed("n", "__y"), "value")
    pairs = both.groupBy(a, b).agg(F.count(F.lit(1)).alias("__s"), F.first(F.col("__x") + F.col("__y")).alias("__n"))
    return pairs.select(a, b, (F.col("__s") / (F.col("__n") - F.col("__s"))).alias("alike"))


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: Sequence[float], ridge: float = 1.0, rounds: int = 30, times: np.ndarray | None = None) -> np.ndarray:
    """Weights, the first for the constant, by Newton's method, drawn to `prior`; with labels of one kind only, the prior.
    `times` says how often each row of x and y occurs, once if left out."""
    x, prior, times = np.column_stack([np.ones(len(x)), x]), np.array(prior, float), np.ones(len(y)) if times is None else times
    if not len(y) or y.min() == y.max():
        return prior
    w, keep = prior.copy(), ridge * np.eye(len(prior))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + keep, x.T @ (times * (y - p)) - keep @ (w - prior))
        w += np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def score(weights: Sequence[float], features: Sequence[str]) -> Column:
    """Linear score of the features as an expression."""
    total = F.lit(float(weights[0]))
    for w, f in zip(weights[1:], features):
        total = total + F.lit(float(w)) * F.col(f)
    return total


def sequence_of(ref: Column) -> dict[str, Column]:
    """Parts of a reference keyed by hand: visit, year and running number as far as they can be read.

    Letters O, I and L inside numbers are read as digits. A number without year has year null.
    """
    words = F.split(F.trim(F.regexp_replace(F.upper(ref), "[^A-Z0-9]+", " ")), " ")
    mended = F.transform(words, lambda t: F.when(t.rlike("^[0-9OIL]*[0-9][0-9OIL]*$"), F.translate(t, "OIL", "011")).otherwise(t))
    text = F.array_join(mended, " ")
    shapes = (  # pattern, place of the year, place of the number; fixed values
        (r"(20[0-9]{2}) ?([0-9]{6})$", 1, 2),
        (r"(?:^|[^0-9])(20[0-9]{2}) ([0-9]{1,7})$", 1, 2),
        (r"([0-9]{1,6}) OF (20[0-9]{2})$", 2, 1),
        (r"^([0-9]{4,6}) ([0-9]{2})$", 2, 1),
        (r"[A-Z]{2,4}([0-9]{2}) ([0-9]{1,6})$", 1, 2),
    )
    year = number = F.lit(None).cast("string")
    for shape, y, n in reversed(shapes):
        hit = text.rlike(shape)
        year = F.when(hit, F.regexp_extract(text, shape, y)).otherwise(year)
        number = F.when(hit, F.regexp_extract(text, shape, n)).otherwise(number)
    number = F.coalesce(number, F.nullif(F.regexp_extract(text, r"(?:^| )([0-9]{1,7})$", 1), F.lit("")))
    full = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    return {"visit": F.when(text.rlike("^V[0-9]{6,}$"), text), "year": full, "number": number.try_cast("int")}


def amount_cells(amount: Column, width: float) -> Column:
    """Place of an amount on a logarithmic scale of steps of that width; null where it is not positive."""
    return F.when(amount > 0, F.log(amount.cast("double")) / F.lit(math.log1p(width)))


#: Features of a pair, and the weights that count if there are not enough labels to learn any (see claim_bill_pairs).
FEATURES = {
    "same_patient": 4, "other_patient": -1, "same_in": 2.5, "near_in": 1, "far_in": -2, "same_out": 2, "near_out": 1, "far_out": -2,
    "amount_equal": 4, "amount_close": 3, "amount_round": 3, "amount_rough": -1, "amount_far": -3,
    "ref_visit": 4, "ref_full": 4, "ref_number": 1.5, "ref_near": 1.5, "ref_other": -2, "before_bill": -1, "alike": 0,
}
CONSTANT = -6.0

#: Labels of either kind from which weights are learned, drawn to zero and not to any judgement made before.
LEARNED = 50


def least_accepted(confidence: np.ndarray, decoy: np.ndarray, share: float, times: np.ndarray | None = None) -> float:
    """The least confidence to accept: steps are taken from the highest down while, among best candidates within one, claims
    that are no chance matches are at least as many as those that are; chance matches are `share` times the decoys there. A
    step with fewer than TELLING claims and decoys is judged with those above it. `times`: how often each occurs."""
    times = np.ones(len(decoy)) if times is None else times
    seen_claims = seen_decoys = 0
    out, above = STEPS[0], 1.01
    for least in STEPS:
        here = (confidence >= least) & (confidence < above)
        seen_claims, seen_decoys = seen_claims + times[here & ~decoy].sum(), seen_decoys + times[here & decoy].sum()
        if seen_claims + seen_decoys >= TELLING:
            if 2 * share * seen_decoys > seen_claims:
                return out
            seen_claims = seen_decoys = 0
        out, above = least, least
    return out


def claim_bill_pairs(claims: DataFrame, bills: DataFrame) -> DataFrame:
    """(claim_id, bill_id, confidence) for every claim and the bill judged to be its own, at most one a claim.

    Candidates share a value of the MinHash sketches over pairs of attributes (patient, days, amounts, reference), taken
    within a hospital, so that one attribute alone, however frequent its value, makes no block. Features say how each
    attribute agrees, and how alike the sketches are. Weak labels: a claim's decoy is the claim as it were had its best
    candidate never been delivered, so the decoy's best candidate is the runner-up; a claim's best is labelled a match, and a
    decoy's, or one that agrees in hardly anything, none. A logistic classifier is fitted on the best candidates of all claims
    and decoys, counted by their features: the driver gets each combination of features once, and these are bounded by the
    values that features have, not by the claims.

    The confidence is the probability that the pair is a match. Platt's method gives p, how probable a pair of that score is a
    claim's and not a decoy's; it is fitted on all labels, each scored by a classifier that has seen only the claims of the
    other FOLDS - 1 parts. Claims and decoys are equally many, so a score is p / (1 - p) times as frequent among claims as
    among decoys; `share` of the claims (told from how many have candidates as poor as decoys') have no bill and score as
    decoys do; so share * (1 - p) / p of the claims' pairs of a score are chance, and the confidence is what is left. A claim
    gets the candidate of highest confidence if that is at least what least_accepted finds on the same scores. Chance matches
    grow with the tables and are found for each input.

    Of a claim's rows the latest counts, with the amounts of the first and the latest. Null ids are left out, repeated rows
    count once, null attributes agree with nothing. An empty table gives an empty one; with fewer than LEARNED labels of either
    kind the weights are those of FEATURES and the least confidence is one half.
    """
    c = claims.filter("claim_id is not null").groupBy("claim_id").agg(
        F.max_by(F.struct("patient_id", "hospital_id", "hospital_ref_no", "submitted_date", "admission_date", "discharge_date", F.col("claim_amount").cast("double").alias("last")), F.struct("export_date", "ingestion_ts")).alias("r"),
        F.min_by(F.col("claim_amount").cast("double"), F.struct("export_date", "ingestion_ts")).alias("first"),
    )
    c = written(c.select("claim_id", "first", "r.*").withColumns(sequence_of(F.col("hospital_ref_no"))), "claims")
    n_claims = c.count()
    b = bills.filter("bill_id is not null").groupBy("bill_id").agg(F.max(F.struct("patient_id", "hospital_id", "visit_id", "admission_date", "discharge_date", F.col("net_payable").cast("double").alias("net"), F.col("gross_amount").cast("double").alias("gross"), "bill_date")).alias("r"))
    own = sequence_of(F.col("bill_id"))
    b = written(b.select("bill_id", "r.*").withColumns({"bill_year": own["year"], "bill_number": own["number"]}), "bills")

    def keys(p: str, day_in: str, day_out: str, fine: Sequence[Column], rough: Sequence[Column], year: str, number: str, visit: str) -> Column:
        h = F.col("hospital_id")
        of = lambda name, *parts: F.concat_ws("|", F.lit(name), h, *[x.cast("string") for x in parts])
        full = lambda name, *parts: F.when(F.greatest(*[x.isNull().cast("int") for x in (h, *parts)], F.lit(0)) == 0, of(name, *parts))
        P, A, D, Y, S, V = map(F.col, (p, day_in, day_out, year, number, visit))
        out = [full("r", Y, S), full("v", V), full("pa", P, A), full("pd", P, D), full("ps", P, S), full("as", A, S), full("ds", D, S)]
        for m in fine:
            out += [full("pm", P, m), full("am", A, m), full("dm", D, m), full("sm", S, m)]
        out += [full("adm", A, D, m) for m in rough]
        return F.array(*out)

    step = lambda x, w, shift=0.0: F.floor(amount_cells(F.col(x), w) + F.lit(shift))
    fine_b = [step(x, 0.04, s) for x in ("net", "gross") for s in (-0.5, 0.5)]
    rough_b = [step("net", 0.4, s) for s in (-0.5, 0.5)]
    left = sketches(c, "claim_id", keys("patient_id", "admission_date", "discharge_date", [step("first", 0.04), step("last", 0.04)], [step("last", 0.4)], "year", "number", "visit"))
    right = sketches(b, "bill_id", keys("patient_id", "admission_date", "discharge_date", fine_b, rough_b, "bill_year", "bill_number", "visit_id"), BILL_SKETCH)
    bb = b.select("bill_id", "bill_year", "bill_number", "bill_date", "visit_id", "net", "gross", F.col("patient_id").alias("bp"), F.col("admission_date").alias("ba"), F.col("discharge_date").alias("bd"))
    pairs = candidates(left, right, "claim_id", "bill_id").join(c, "claim_id").join(bb, "bill_id")

    yes = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    off = F.least(*[F.abs(F.col(x) - F.col(y)) / F.greatest(F.col(y), F.lit(0.01)) for x in ("first", "last") for y in ("net", "gross")])
    rounded = F.greatest(*[(F.abs(F.col(x) - F.col(y)) <= 500) & (F.pmod(F.col(x), F.lit(100.0)) == 0) & (F.abs(F.col(x) - F.col(y)) <= 0.05 * F.col(y)) for x in ("first", "last") for y in ("net", "gross")])
    days = lambda x, y: F.abs(F.datediff(x, y))
    code = lambda y, s: F.concat(F.coalesce(y, F.lit("")), F.lpad(s.cast("string"), 6, "0"))
    visit = yes(F.col("visit") == F.col("visit_id"))
    whole = yes((F.col("year") == F.col("bill_year")) & (F.col("number") == F.col("bill_number")))
    alone = yes(F.col("number") == F.col("bill_number")) * (1 - whole)
    # bills of one day have numbers that differ by little, so such a number is another bill's and no slip of the pen
    near = yes((F.levenshtein(code(F.col("year"), F.col("number")), code(F.col("bill_year"), F.col("bill_number"))) <= 1) & ((F.abs(F.col("number") - F.col("bill_number")) > 9) | (F.col("year") != F.col("bill_year")))) * (1 - whole) * (1 - alone)
    told = yes((F.col("number").isNotNull() & F.col("year").isNotNull()) | F.col("visit").isNotNull())
    f = {
        "same_patient": yes(F.col("patient_id") == F.col("bp")), "other_patient": yes(F.col("patient_id") != F.col("bp")),
        "same_in": yes(F.col("admission_date") == F.col("ba")), "near_in": yes(days("admission_date", "ba").between(1, 4)), "far_in": yes(days("admission_date", "ba") > 4),
        "same_out": yes(F.col("discharge_date") == F.col("bd")), "near_out": yes(days("discharge_date", "bd").between(1, 4)), "far_out": yes(days("discharge_date", "bd") > 4),
        "amount_equal": yes(off < 0.0005), "amount_close": yes(off.between(0.0005, 0.0155)), "amount_round": yes(rounded & (off >= 0.0155)), "amount_rough": yes((off > 0.0155) & (off <= 0.2)) * (1 - yes(rounded)), "amount_far": yes(off > 0.2),
        "ref_visit": visit, "ref_full": whole, "ref_number": alone, "ref_near": near, "ref_other": told * (1 - visit) * (1 - whole) * (1 - alone) * (1 - near),
        "before_bill": yes(F.col("submitted_date") < F.col("bd")), "alike": F.col("alike"),
    }
    agree = F.col("same_patient") + F.col("same_in") + 0.5 * F.col("same_out") + F.col("amount_equal") + 0.75 * (F.col("amount_close") + F.col("amount_round")) + F.col("ref_visit") + F.col("ref_full") + 0.5 * F.col("ref_number") + 0.5 * F.col("ref_near")
    pairs = pairs.select("claim_id", "bill_id", *[v.alias(k) for k, v in f.items()]).withColumn("agree", agree)
    pairs = written(pairs, "pairs")
    names = list(FEATURES)
    rank = F.row_number().over(Window.partitionBy("claim_id").orderBy(F.desc("agree"), F.desc("bill_id")))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "claim_id"), F.lit(FOLDS)).cast("int")
    ends = pairs.withColumn("rank", rank).filter("rank <= 2").withColumn("group", fold + F.lit(FOLDS) * (F.col("rank") - 1))
    flags = [F.col(n).cast("double" if n == "alike" else "tinyint").alias(n) for n in names]
    counts = ends.groupBy("agree", *flags).agg(*[F.count_if(F.col("group") == i).alias(f"n{i}") for i in range(2 * FOLDS)])
    kinds = counts.toArrow().to_pandas().sort_values(["agree", *names])  # by features, so sums have one order
    n_of = kinds[[f"n{i}" for i in range(2 * FOLDS)]].to_numpy()
    at, group = np.nonzero(n_of)
    x, agreed, times = kinds[names].to_numpy(float)[at], kinds["agree"].to_numpy(float)[at], n_of[at, group].astype(float)
    looked, fold_of, weak = group >= FOLDS, group % FOLDS, agreed <= 1
    y = (~looked & ~weak).astype(float)
    told = min(times @ y, times @ (1 - y)) >= LEARNED
    learn = lambda of: fit_logistic(x[of], y[of], [0.0] * (len(names) + 1), times=times[of]) if told else np.array([CONSTANT, *FEATURES.values()], float)
    w, z = learn(fold_of >= 0), np.zeros(len(y))
    for i in range(FOLDS):
        z[fold_of == i] = np.column_stack([np.ones(len(x)), x])[fold_of == i] @ learn(fold_of != i)
    slope = fit_logistic(z[:, None], y, [0.0, 1.0], ridge=0.1, times=times)
    lone = lambda d: (n_claims - times[(looked == d) & ~weak].sum()) / max(n_claims, 1)
    share = float(np.clip(lone(False) / max(lone(True), 0.01), 0.01, 0.9))
    sure = np.maximum(0, 1 - share / np.exp(np.clip(slope[0] + slope[1] * z, -30, 30)))
    accept = least_accepted(sure, looked, share, times) if told else 0.5
    odds = F.exp(F.lit(float(slope[0])) + F.lit(float(slope[1])) * F.col("z"))
    pairs = pairs.withColumn("z", score(w, names)).withColumn("confidence", F.greatest(F.lit(0.0), 1 - F.lit(share) / odds))
    best = pairs.filter(F.col("confidence") >= accept).groupBy("claim_id").agg(F.max_by(F.struct("bill_id", "confidence"), F.struct("z", "agree", "bill_id")).alias("r"))
    return best.select("claim_id", "r.bill_id", "r.confidence")
