"""Variant spellings of names: an exact radius join in metric cells, then a look at each close pair of rows."""

from __future__ import annotations

from collections import defaultdict
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_phone
from ..operators.lookup import lookup
from ..session import written
from .groups import hash_to_min

#: Words before a name that are no part of it.
TITLES = ("mr", "mrs", "ms", "miss", "master", "baby", "dr", "prof", "shri", "sri", "smt", "kum", "kumari")

#: Spellings of the same sound, replaced in this order.
SOUNDS = (("ph", "f"), ("w", "v"), ("ee", "i"), ("oo", "u"), ("y", "i"), ("ck", "k"), (r"c(?!h|\b)", "k"), ("th", "t"), ("q", "k"), ("z", "j"), (r"([a-z])\1+", "$1"))

#: Edit distance up to which two words may be spellings of one name.
RADIUS = 2


def plain_name(c: Column) -> Column:
    """Lower case words of letters with single blanks, without titles in front; null stays null."""
    words = F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "'", ""), "[^a-z]+", " "))
    title = "^((" + "|".join(TITLES) + ") )+(?=[a-z])"
    return F.regexp_replace(words, title, "")


def sound(c: Column) -> Column:
    """Words with the spellings of one sound made equal."""
    for a, b in SOUNDS:
        c = F.regexp_replace(c, a, b)
    return c


def radius_join(elements: DataFrame, anchor: str, word: str, row: str, radius: int = RADIUS, cell: int = 16) -> DataFrame:
    """(a, b), a < b: pairs of rows that share an anchor and have words within `radius` of each other, each pair once.

    The space is that of (anchor, word) with Levenshtein's distance between words of one anchor and an infinite one between
    anchors: a metric. Words of an anchor are assigned to their nearest pivot; pivots are words of the anchor, drawn by hash,
    about sqrt(n / cell) of its n words, so that large anchors have many cells. A word whose distance to another pivot is at
    most 2 * radius more than to its own is repeated there: by the triangle inequality each pair within the radius then meets
    in the cell of either of its words. Inside a cell the distance is computed exactly. Nothing is dropped at any size, and no
    task sees an anchor as a whole but for its pivots. Equal words are compared once and stand for all their rows; nulls are
    dropped.
    """
    rows = elements.select(F.col(anchor).alias("k"), F.col(word).alias("w"), F.col(row).alias("r")).dropna().distinct()
    rows = written(rows, "elements")  # read four times below
    words = written(rows.select("k", "w").distinct(), "words")
    large = words.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell)
    drawn = F.pmod(F.xxhash64("w"), F.lit(1 << 20)) < F.lit(1 << 20) * F.sqrt(F.col("n") * cell) / (F.col("n") * cell)
    pivots = words.join(large, "k").filter(drawn).groupBy("k").agg(F.sort_array(F.collect_list("w")).alias("pivots"))
    placed = words.join(pivots, "k", "left")
    far = F.transform("pivots", lambda p: F.levenshtein("w", p))
    placed = placed.withColumn("far", far).withColumn("near", F.array_min("far"))
    home = F.coalesce(F.array_position("far", F.col("near")).cast("int"), F.lit(1))
    kept = F.filter(F.sequence(F.lit(1), F.size("far")), lambda i: F.get("far", i - 1) <= F.col("near") + 2 * radius)
    placed = placed.select("k", "w", home.alias("home"), F.when(F.col("far").isNull(), F.array(F.lit(1))).otherwise(kept).alias("cells"))
    placed = written(placed, "placed")  # distances to pivots are computed once for both sides
    there = placed.select("k", F.col("w").alias("x"), F.explode("cells").alias("home"))
    close = placed.select("k", "w", "home").join(there, ["k", "home"]).filter(F.levenshtein("w", "x", radius) >= 0)
    close = close.select("k", F.least("w", "x").alias("w"), F.greatest("w", "x").alias("x")).distinct()
    left = close.join(rows.withColumnRenamed("r", "p"), ["k", "w"]).select("k", "x", "p")
    both = left.join(rows.select("k", F.col("w").alias("x"), F.col("r").alias("q")), ["k", "x"]).filter("p <> q")
    return both.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with neighbouring letters swapped as one edit, or most + 1 if it is greater."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    older, old = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(old[j] + 1, new[j - 1] + 1, old[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            new.append(v)
        if min(new) > most:
            return most + 1
        older, old = old, new
    return old[-1]


def close_words(a: str, b: str) -> bool:
    n = min(len(a), len(b))
    return distance(a, b, 2) <= (2 if n >= 6 or (n == 5 and a[0] == b[0]) else 1 if n >= 3 else 0)


def word_match(a: tuple[str, str], b: tuple[str, str], nick: dict[str, set[str]]) -> int:
    """3 the same or a spelling of it, 2 a nickname, 1 an initial, 0 another name. Words are (as typed, as sounded)."""
    (typed, x), (other, y) = a, b
    if x == y and len(typed) > 1 and len(other) > 1:
        return 3
    if len(typed) == 1 or len(other) == 1:
        return 1 if typed[0] == other[0] or x[0] == y[0] else 0
    if close_words(x, y) or close_words(typed, other):
        return 3
    fa, fb = nick.get(x, ()), nick.get(y, ())
    if any(f == y or close_words(f, y) for f in fa) or any(f == x or close_words(f, x) for f in fb):
        return 2
    return 0


def best_sum(grades: list[list[int]]) -> int:
    """Greatest sum of one positive grade from each row, all in different columns (at least as many as rows); 0 if there is none.

    An assignment by shortest augmenting paths, cubic in the words of a name.
    """
    n, m = len(grades), len(grades[0])
    none = 4 * n + 1  # dearer than all other rows together
    cost = [[4 - g if g else none for g in row] for row in grades]
    u, v, owner = [0] * (n + 1), [0] * (m + 1), [0] * (m + 1)  # column 0 starts each path
    for i in range(1, n + 1):
        owner[0], at = i, 0
        least, back, seen = [float("inf")] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while owner[at]:
            seen[at], row = True, owner[at]
            for j in range(1, m + 1):
                if not seen[j] and (c := cost[row - 1][j - 1] - u[row] - v[j]) < least[j]:
                    least[j], back[j] = c, at
            to = min((j for j in range(1, m + 1) if not seen[j]), key=least.__getitem__)
            step = least[to]
            for j in range(m + 1):
                if seen[j]:
                    u[owner[j]] += step
                    v[j] -= step
                else:
                    least[j] -= step
            at = to
        while at:
            owner[at], at = owner[back[at]], back[at]
    own = [grades[owner[j] - 1][j - 1] for j in range(1, m + 1) if owner[j]]
    return sum(own) if all(own) else 0


def run_together(words: list[tuple[str, str]]) -> set[str]:
    """A name's words without blanks, forwards and backwards, beginning with each of them: all orders of up to three words."""
    ways = ([w for _, w in words], [w for _, w in reversed(words)])
    return {"".join(z[i:] + z[:i]) for z in ways for i in range(len(z))}


def name_match(a: list[tuple[str, str]], b: list[tuple[str, str]], nick: dict[str, set[str]]) -> int:
    """How well two names agree whatever their order: 0 not, else the sum over words of the shorter (all must match, one
    of them as more than an initial). Names run together are compared without blanks, in the order given or reversed and from
    any word on."""
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    best = best_sum([[word_match(x, y, nick) for y in b] for x in a])
    if best <= len(a) or (len(a) == 1 and len(b) > 1):
        best = 0  # initials alone, or one word of several, are not a name
    if not best and len(a) != len(b):
        for x in run_together(a):
            for y in run_together(b):
                if min(len(x), len(y)) >= 7 and distance(x, y, 2) <= 2:
                    return 3
    return best


def _slip(y: int, m: int, d: int, z: int, n: int, e: int) -> bool:
    """True days of the year at most 3 apart, over the turn of the year as well, and years at most 2 apart."""
    if abs(y - z) > 2 or m > 12 or n > 12:
        return False
    day = lambda v, i, j: date(v, i, 1) + timedelta(j - 1)  # noqa: E731  29 February is 1 March in other years
    return any(abs((day(y, m, d) - day(v, n, e)).days) <= 3 for v in (y - 1, y, y + 1) if 0 < v < 9999)


def near_dates(a: str, b: str) -> str:
    """'same', 'swapped' (day and month), 'near' (a slip of days and years, with day and month of either one swapped or not, of a
    month, or one digit), 'far', '' if unknown."""
    if not a or not b:
        return ""
    if a == b:
        return "same"
    (y, m, d), (z, n, e) = (tuple(map(int, x.split("-"))) for x in (a, b))
    if y == z and (m, d) == (e, n):
        return "swapped"
    if sum(p != q for p, q in zip(a, b)) == 1:
        return "near"
    if _slip(y, m, d, z, n, e) or _slip(y, m, d, z, e, n) or _slip(y, d, m, z, n, e):
        return "near"
    return "near" if y == z and abs((m - n) * 31 + d - e) <= 31 else "far"


def near_phones(a: str, b: str) -> str:
    if not a or not b:
        return ""
    return "same" if a == b else "near" if distance(a, b, 2) <= 1 else "far"


def person_pairs(people: DataFrame, nicknames: DataFrame, key: str = "mpi_id") -> DataFrame:
    """(a, b), a < b: rows of one person, by key.

    Words of each name, their full forms if they are nicknames, and the name run together are joined by radius within equal
    phone numbers, birth dates (day and month in either order), and phone numbers equal but for a digit left out: those of
    numbers one edit or swap of neighbours apart meet there. Each close pair is then looked at: gender or blood group
    that differ rule it out; the names must agree word by word in some order; and phone and birth date must agree well enough
    (equal phone and not a far birth date, or equal birth date, or near ones of both). Pairs are closed over groups by
    hash_to_min, and pairs of a group whose gender or blood group differ are left out.

    Rows with null key or name, or without both phone and birth date, are linked to nothing; repeated rows count once (of
    rows with one key any differing values are all used). Nicknames is a fixed list and sent to the workers. No pair for an
    empty table. Name, phone, gender, dob and blood_group are read; other columns are not.
    """
    spark = people.sparkSession
    rows = people.select(
        F.col(key).alias("r"), plain_name(F.col("name")).alias("typed"), sound(plain_name(F.col("name"))).alias("n"), F.coalesce(normalize_phone(F.col("phone")), F.lit("")).alias("ph"),
        F.coalesce(F.date_format("dob", "yyyy-MM-dd"), F.lit("")).alias("dob"), F.upper(F.substring(F.trim("gender"), 1, 1)).alias("g"), F.upper(F.trim("blood_group")).alias("bl"),
    ).filter("r is not null and n <> ''").distinct()
    every = written(rows, "people")
    # rows alike, with a name and an anchor to match by, stand under the least key of them; all others for themselves
    told = F.col("typed").rlike("[a-z]{2}") & ((F.col("ph") != "") | (F.col("dob") != ""))
    about = ["typed", "n", "ph", "dob", "g", "bl"]
    alike = F.struct(*about, F.when(told, F.lit("")).otherwise(F.col("r")).alias("own"))  # structs take null for equal to null
    heads = every.groupBy(alike.alias("k")).agg(F.min("r").alias("head"))
    copies = lookup(every.select("r", alike.alias("k")), heads, ["k"], "inner").filter("r <> head").select(F.least("head", "r").alias("a"), F.greatest("head", "r").alias("b"))
    rows = written(heads.select(F.col("head").alias("r"), *[F.col(f"k.{c}") for c in about]), "heads")
    short = nicknames.select(sound(plain_name(F.col("short_form"))).alias("s"), sound(plain_name(F.col("full_form"))).alias("f")).dropna().distinct()
    nick: dict[str, set[str]] = defaultdict(set)
    for s, f in short.collect():  # a fixed list
        nick[s].add(f)
    split = F.split("n", " ")
    m, d = F.substring("dob", 6, 2), F.substring("dob", 9, 2)
    day = F.when(F.col("dob") != "", F.concat(F.lit("d"), F.substring("dob", 1, 4), F.least(m, d), F.greatest(m, d)))
    anchors = F.array_compact(F.array(F.when(F.col("ph") != "", F.concat(F.lit("p"), "ph")), day))
    less = F.transform(F.sequence(F.lit(1), F.length("ph")), lambda i: F.concat(F.substring(F.col("ph"), F.lit(1), i - 1), F.substring(F.col("ph"), i + 1, F.length("ph"))))
    slips = rows.filter("ph <> ''").select("r", "ph", F.explode(F.array_distinct(F.concat(F.array("ph"), less))).alias("k"))
    slips = slips.join(slips.groupBy("k").agg(F.min("ph").alias("x"), F.max("ph").alias("y")).filter("x <> y").select("k"), "k")
    slips = slips.select("r", F.concat(F.lit("s"), "k").alias("k")).distinct().join(rows, "r")
    anchored = rows.withColumn("k", F.explode(anchors)).unionByName(slips.select(*rows.columns, "k"))
    anchored = written(anchored.select("r", "k", split.alias("ws")), "anchored")
    # names run together are compared only with names of another number of words, so only where an anchor has both
    mixed = anchored.groupBy("k").agg(F.min(F.size("ws")).alias("x"), F.max(F.size("ws")).alias("y")).filter("x < y").select("k")
    joined = F.array_distinct(F.array(F.array_join("ws", ""), F.array_join(F.reverse("ws"), "")))
    words = anchored.select("r", "k", F.explode("ws").alias("w")).unionByName(anchored.join(mixed, "k", "left_semi").select("r", "k", F.explode(joined).alias("w"))).filter("length(w) > 1")
    full = words.join(F.broadcast(short.withColumnRenamed("s", "w")), "w").select("r", "k", F.col("f").alias("w"))
    close = radius_join(words.unionByName(full), "k", "w", "r")
    x, y = (rows.select(*[F.col(c).alias(f"{c}{i}") for c in rows.columns]) for i in (1, 2))
    agree = lambda c: F.coalesce(F.col(f"{c}1") == F.col(f"{c}2"), F.lit(True))
    seen = close.join(x, F.col("a") == F.col("r1")).join(y, F.col("b") == F.col("r2")).filter(agree("g") & agree("bl"))
    sent = spark.sparkContext.broadcast(dict(nick))

    @F.pandas_udf("boolean")
    def one_person(t1: pd.Series, t2: pd.Series, n1: pd.Series, n2: pd.Series, p1: pd.Series, p2: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        known, out = sent.value, []
        words = lambda t, n: list(zip(t.split(" "), n.split(" ")))
        for t, u, a, b, p, q, d, e in zip(t1, t2, n1, n2, p1, p2, d1, d2):
            phone, date = near_phones(p, q), near_dates(d, e)
            fits = date == "same" or (phone == "same" and date != "far") or (phone == "near" and date in ("swapped", "near")) or (phone == "" and date == "swapped")
            out.append(fits and name_match(words(t, a), words(u, b), known) > 0)
        return pd.Series(out, dtype=bool)

    links = seen.filter(one_person("typed1", "typed2", "n1", "n2", "ph1", "ph2", "dob1", "dob2")).select("a", "b").unionByName(copies).distinct()
    links = written(links, "links")
    found = hash_to_min(links, "a", "b")
    marks = every.groupBy(F.col("r").alias("node")).agg(F.max("g").alias("g"), F.max("bl").alias("bl"))
    found = found.join(marks, "node")
    one, two = (found.select("group", *[F.col(c).alias(f"{c}{i}") for c in ("node", "g", "bl")]) for i in (1, 2))
    pairs = one.join(two, "group").filter(F.col("node1") < F.col("node2")).filter(agree("g") & agree("bl"))
    return pairs.select(F.col("node1").alias("a"), F.col("node2").alias("b"))
