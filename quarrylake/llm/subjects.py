"""Subject areas of texts: weighted terms, truncated singular value decomposition, refined centroids, sentence by sentence."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most labelled documents that the model is fitted on, drawn evenly by hash, and most sentences of each.
SAMPLE, SENTENCES = 3_000, 20

#: Sentences that a subject's description counts for.
DESCRIPTIONS = 10

#: Dimensions kept, most rounds of refinement, parts into which the sentences of a subject and language are pooled.
RANK, ROUNDS, PARTS = 64, 10, 4

#: Share of the sentences that may still move in a round for the centroids to count as stable.
STABLE = 0.001

#: Evidence (length along the centroid) from which a sentence may be about a subject: tried in these steps on labels held out.
STEPS = tuple(round(0.05 * i, 2) for i in range(1, 17))

#: Least sentences with a term, least weight of a term, least length and cosine for a sentence to be about a subject.
SEEN, WEIGHT, LENGTH, COSINE = 3, 0.3, 0.2, 0.3

#: Share of the sentences about any subject from which a document is about one.
SHARE = 0.25

#: Stands between sentences among the words of a text.
END = "\x00"

_WORDS = re.compile(r"[a-zß-ÿ]+(?:'[a-z]+)?|[ऀ-ॣ॰-ॿ]+|\x00").findall
_HYPHEN = re.compile(r"-\n(?=\w)")
_TAG = re.compile(r"<[^>]{0,40}>")
_BREAK = re.compile(r"[.!?।]+(?:\s+|$)|\n\s*\n|\n\s*[-*•]\s|(?<=[.!?।:;>\"”)])\s*\n").sub


def scanned(text: str | None) -> list[str]:
    """Words of a text in lower case, with END where a sentence does; words broken at line ends are joined, tags end a sentence."""
    if not text:
        return []
    text = text.lower().replace(END, " ")
    if "-\n" in text:
        text = _HYPHEN.sub("", text)
    if "<" in text:
        text = _TAG.sub("\n\n", text)
    return _WORDS(_BREAK(END, text))


def sentences(text: str | None) -> list[list[str]]:
    """Words of each sentence that has any."""
    out, own = [], []
    for w in [*scanned(text), END]:
        if w != END:
            own.append(w)
        elif own:
            out.append(own)
            own = []
    return out


def terms(words: list[str]) -> set[str]:
    """Words and pairs of neighbouring words."""
    return {*words, *map(" ".join, zip(words, words[1:]))}


def summed(vectors: np.ndarray, row: np.ndarray, term: np.ndarray, rows: int) -> np.ndarray:
    """Sum of the vectors of each row's terms; `row` ascends. Rows are taken longest first, and the first terms of all are
    added at once, then the second ones of those that have two, and so on."""
    out = np.zeros((rows, vectors.shape[1]), np.float32)
    if len(row):
        start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        count = np.diff(np.append(start, len(row)))
        order = np.argsort(-count, kind="stable")
        start, less = start[order], -count[order]
        total = np.zeros((len(start), vectors.shape[1]), np.float32)
        for k in range(-less[0]):
            n = np.searchsorted(less, -k, "left")
            total[:n] += vectors[term[start[:n] + k]]
        out[row[start]] = total
    return out


@dataclass
class Model:
    """Terms and the vector of each; centroids and the subject of each; the evidence that a sentence needs.

    Terms are kept as numbers of words: `word` gives a word's number (END is -1), `single` the term of a word or -1, `codes` the
    ascending numbers of pairs of words and `pair` their terms.
    """

    names: list[str]
    word: dict[str, int]
    single: np.ndarray
    codes: np.ndarray
    pair: np.ndarray
    vectors: np.ndarray
    centroids: np.ndarray
    subject_of: np.ndarray
    kept: np.ndarray  # the terms' numbers where it was fitted
    evidence: float = 0.0

    def terms_of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        """(sentence, term) of every different term of each sentence, ascending, and the number of sentences; END begins one."""
        ids = np.fromiter(map(self.word.get, tokens, repeat(-2)), np.int64, len(tokens))
        sentence = np.cumsum(ids == -1)
        here = np.flatnonzero(ids >= 0)
        one = self.single[ids[here]]
        both = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        code = ids[both] * len(self.word) + ids[both + 1]
        at = np.searchsorted(self.codes, code)
        hit = self.codes[np.minimum(at, max(len(self.codes) - 1, 0))] == code if len(self.codes) else np.zeros(len(code), bool)
        size = max(len(self.vectors), 1)
        key = np.concatenate([sentence[here[one >= 0]] * size + one[one >= 0], sentence[both[hit]] * size + self.pair[at[hit]]])
        key = np.unique(key)
        return key // size, key % size, int(sentence[-1]) + 1 if len(tokens) else 0

    def about(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subject of each embedded sentence (-1: none) but for the evidence asked for, and its evidence: how long it is in the
        direction of the nearest centroid, so that a few terms that tell little make no subject however well they fit."""
        near, cosine, length = self.judge(x)
        return np.where((length >= LENGTH) & (cosine >= COSINE), near, -1), length * np.maximum(cosine, 0)

    def areas(self, doc: np.ndarray, near: np.ndarray, docs: int, share: float) -> tuple[np.ndarray, np.ndarray]:
        """(document, subject) for the subjects that take up at least `share` of a document's sentences about any."""
        some = near >= 0
        n = max(len(self.names), 1)
        count = np.bincount(doc[some] * n + near[some], minlength=docs * n).reshape(docs, n)
        return np.nonzero((count > 0) & (count >= share * count.sum(1, keepdims=True)))

    def judge(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Subject of the nearest centroid, its cosine, and length of each embedded sentence."""
        length = np.linalg.norm(x, axis=1)
        if not len(self.centroids) or not len(x):
            return np.zeros(len(x), int), np.zeros(len(x)), length
        cosine = (x / np.maximum(length, 1e-9)[:, None]) @ self.centroids.T
        best = cosine.argmax(1)
        return self.subject_of[best], cosine[np.arange(len(x)), best], length


class Told:
    """Sentences whose document's subjects are known, as numbers: built once, fitted on as a whole or in part."""

    def __init__(self, names: list[str], told: list[tuple[frozenset[int], str, list[str]]]):
        number: dict[str, int] = {}
        lists = [[number.setdefault(t, len(number)) for t in terms(w)] for _, _, w in told]
        self.names, self.terms = names, list(number)
        self.row = np.repeat(np.arange(len(told)), [len(x) for x in lists]).astype(np.int64)
        self.term = np.fromiter((t for x in lists for t in x), np.int64, len(self.row))
        self.own = np.zeros((len(told), len(names)), bool)
        for r, (s, _, _) in enumerate(told):
            self.own[r, list(s)] = True
        self.langs = sorted({lang for _, lang, _ in told})
        place = {x: i for i, x in enumerate(self.langs)}
        self.lang = np.array([place[x] for _, x, _ in told], np.int64)


def fit(told: Told, rows: np.ndarray | None = None) -> Model:
    """Model from the told sentences, or from those of the given rows.

    Sentences of documents with one subject seed it. A term weighs as much as its share among the subjects differs from an
    even one (nothing if it is as frequent everywhere). Sentences of a subject and language are pooled into PARTS documents
    whose weighted terms are decomposed; terms get the coordinates of the RANK greatest singular values, sentences the sum of
    their terms', and each subject and language a centroid. In each round sentences move to the nearest centroid: one of
    the document's own subjects, or none if a foreign subject or nothing is near, and all is computed anew until hardly any
    sentence moves (STABLE), ROUNDS times at most.
    """
    rows = np.arange(len(told.own)) if rows is None else rows
    number = np.full(len(told.own), -1)
    number[rows] = np.arange(len(rows))
    row, own, lang, langs = number[told.row], told.own[rows], told.lang[rows], told.langs
    seen = np.bincount(told.term[row >= 0], minlength=len(told.terms))
    kept = np.flatnonzero(seen >= SEEN) if (seen >= SEEN).any() else np.flatnonzero(seen > 0)
    place = np.full(len(told.terms), -1)
    place[kept] = np.arange(len(kept))
    used = (row >= 0) & (place[told.term] >= 0)
    row, found = row[used], place[told.term[used]]
    order = np.argsort(row, kind="stable")
    row, found = row[order], found[order]
    n, names = len(told.names), told.names
    part = np.arange(len(rows)) % PARTS
    at = np.where(own.sum(1) == 1, own.argmax(1), -1)  # -1 unknown, n none
    model = Model(names, {}, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((len(kept), 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.int64), kept)
    for _ in range(ROUNDS):
        k = at[row] >= 0
        count = np.bincount(found[k] * (n + 1) + at[row][k], minlength=len(kept) * (n + 1)).reshape(len(kept), n + 1)
        size = np.bincount(at[at >= 0], minlength=n + 1) + 1.0
        share = count / size + 0.3 / size.mean()
        share /= share.sum(1, keepdims=True)
        weight = np.log(n + 1) + (share * np.log(share)).sum(1)
        weight[weight < min(WEIGHT, weight.max(initial=0))] = 0
        live = np.flatnonzero(weight > 0)  # terms without weight have no vector
        line = np.full(len(kept), -1)
        line[live] = np.arange(len(live))
        pools = n * len(langs) * PARTS
        pool = (at * len(langs) + lang) * PARTS + part
        k = (at[row] >= 0) & (at[row] < n) & (line[found] >= 0)
        mass = np.bincount(line[found[k]] * pools + pool[row][k], minlength=len(live) * pools).reshape(len(live), pools)
        held = np.bincount(pool[(at >= 0) & (at < n)], minlength=pools)
        mass = np.log1p(mass / np.sqrt(held + 5.0)) * weight[live, None]
        mass /= np.maximum(np.linalg.norm(mass, axis=0), 1e-9)
        value, turn = np.linalg.eigh(mass.T @ mass)
        top = [i for i in np.argsort(-value)[:RANK] if value[i] > 1e-9]
        model.vectors = np.zeros((len(kept), max(len(top), 1)), np.float32)
        model.vectors[live, : len(top)] = mass @ turn[:, top] / np.sqrt(value[top]) * weight[live, None]
        some = line[found] >= 0
        x = summed(model.vectors, row[some], found[some], len(rows))
        unit = x / np.maximum(np.linalg.norm(x, axis=1), 1e-9)[:, None]
        groups = [(s, g) for s in range(n) for g in range(len(langs)) if ((at == s) & (lang == g)).any()]
        means = [unit[(at == s) & (lang == g)].mean(0) for s, g in groups]
        model.centroids = np.array([m / max(np.linalg.norm(m), 1e-9) for m in means], np.float32).reshape(len(groups), -1)
        model.subject_of = np.array([s for s, _ in groups], np.int64)
        near, cosine, length = model.judge(x)
        clear = (length >= LENGTH) & (cosine >= COSINE)
        before = at
        at = np.where(clear, np.where(own[np.arange(len(near)), near], near, -1), n) if len(near) else at
        if (at != before).sum() <= STABLE * len(at):
            break
    live = np.flatnonzero(np.abs(model.vectors).sum(1) > 0)
    model.vectors, model.kept = model.vectors[live], kept[live]
    texts = [told.terms[kept[i]].split(" ") for i in live]
    model.word = {END: -1} | {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    model.single = np.full(len(model.word), -1, np.int64)
    pairs = []
    for j, t in enumerate(texts):
        if len(t) == 1:
            model.single[model.word[t[0]]] = j
        else:
            pairs.append((model.word[t[0]] * len(model.word) + model.word[t[1]], j))
    model.codes, model.pair = (np.array(c, np.int64) for c in (zip(*sorted(pairs)) if pairs else ((), ())))
    return model


def held_out_evidence(told: Told, doc: np.ndarray, first: int, share: float) -> float:
    """The evidence with which a model fitted on one half of the labelled documents agrees in full with most documents of the
    other, both halves in turn; of agreements nearly as good (mean of three steps) the middle one. 0 with fewer than 40 documents.

    doc: each told sentence's document, ascending from 0 for those from row `first` on; sentences before it seed both halves.
    """
    docs = int(doc[-1]) + 1 if len(doc) else 0
    if docs < 40:
        return 0.0
    agree = np.zeros(len(STEPS))
    base, rest = np.arange(first), np.arange(first, len(told.own))
    own = np.zeros((docs, len(told.names)), bool)
    own[doc] = told.own[rest]
    for half in (0, 1):
        model = fit(told, np.concatenate([base, rest[doc % 2 != half]]))
        place = np.full(len(told.terms), -1)
        place[model.kept] = np.arange(len(model.kept))
        held = doc % 2 == half
        number = np.full(len(told.own), -1)
        number[rest[held]] = np.arange(held.sum())
        used = (number[told.row] >= 0) & (place[told.term] >= 0)
        near, evidence = model.about(summed(model.vectors, number[told.row[used]], place[told.term[used]], int(held.sum())))
        for k, least in enumerate(STEPS):
            got = np.zeros((docs, len(told.names)), bool)
            got[model.areas(doc[held], np.where(evidence >= least, near, -1), docs, share)] = True
            agree[k] += (got[half::2] == own[half::2]).all(1).sum()
    smooth = np.convolve(np.pad(agree, 1, "edge"), np.ones(3) / 3, "valid")
    best = np.flatnonzero(smooth >= smooth.max() - 1e-9)
    return STEPS[best[len(best) // 2]]


def _order(t):
    return sorted(t[0]), t[1], t[2]


def labelled_sentences(documents: DataFrame, labels: DataFrame, names: list[str], sample: int = SAMPLE) -> dict[object, list[tuple[frozenset[int], str, list[str]]]]:
    """By document: sentences of at most about `sample` labelled ones, at most SENTENCES of each, evenly over its text."""
    place = {s: i for i, s in enumerate(names)}
    by_doc = labels.dropna(subset=["doc_id", "subject"]).groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    n = by_doc.count()
    if n > sample:
        by_doc = by_doc.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(1_000_000 * sample / n)))
    chosen = documents.select("doc_id", "text", "lang").join(F.broadcast(by_doc), "doc_id")  # about `sample` ids

    def cut(batches):
        for pdf in batches:
            out = []
            for doc, subjects, lang, text in zip(pdf["doc_id"], pdf["subjects"], pdf["lang"], pdf["text"]):
                some = sentences(text)
                for i in np.unique(np.linspace(0, len(some) - 1, min(len(some), SENTENCES)).astype(int)) if some else []:
                    out.append((doc, sorted(subjects), lang or "", " ".join(some[i])))
            yield pd.DataFrame(out, columns=["doc_id", "subjects", "lang", "words"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    out: dict[object, list] = {}  # in order of text within a document
    for r in chosen.mapInPandas(cut, f"doc_id {kind}, subjects array<string>, lang string, words string").collect():
        own = frozenset(place[s] for s in r["subjects"] if s in place)
        if own:
            out.setdefault(r["doc_id"], []).append((own, r["lang"], r["words"].split(" ")))
    return out


def subject_areas(documents: DataFrame, labels: DataFrame, subjects: DataFrame, sample: int = SAMPLE, share: float = SHARE) -> DataFrame:
    """(doc_id, subject) for every subject that takes up at least `share` of the document's sentences about any subject.

    The model is fitted on a bounded sample of labelled documents and on the subjects' descriptions; every sentence of every
    text is judged by it. A sentence without weighty terms, near no centroid, or with less evidence than labels held out ask
    for (see held_out_evidence) is about nothing. Null, empty and blank texts
    and texts about nothing have no row; labels with unknown subjects are left out; without labels the descriptions alone are
    the seeds. Repeated rows are judged alike and stay. Extra columns are not read.
    """
    spark = documents.sparkSession
    known = [(r["subject"], r["description"] or "") for r in subjects.select("subject", "description").dropna(subset=["subject"]).distinct().orderBy("subject").collect()]
    names = list(dict.fromkeys(s for s, _ in known))
    seeds = [(frozenset([names.index(s)]), "en", w) for s, d in known for w in sentences(f"{s}. {d}")] * DESCRIPTIONS
    model = None
    if names:
        by_doc = labelled_sentences(documents, labels, names, sample)
        ids = sorted(by_doc)
        told = Told(names, seeds + [t for i in ids for t in by_doc[i]])
        doc = np.repeat(np.arange(len(ids)), [len(by_doc[i]) for i in ids])
        evidence = held_out_evidence(told, doc, len(seeds), share)
        model = fit(told)
        model.evidence = evidence
    sent = spark.sparkContext.broadcast(model)
    kind = documents.schema["doc_id"].dataType

    def judge(batches):
        m = sent.value
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows, found = [], []

            def flush(first, tokens, begins):
                """Judges the documents from number `first` on, whose sentences begin with the given ones."""
                sentence, term, n = m.terms_of(tokens)
                near, evidence = m.about(summed(m.vectors, sentence, term, n))
                near = np.where(evidence >= m.evidence, near, -1)
                doc = np.searchsorted(np.array(begins), np.arange(n), "right") - 1
                d, s = m.areas(doc[1:], near[1:], len(begins), share)
                rows.append(first + d)
                found.append(s)

            first, tokens, begins, ends = 0, [], [], 0
            for i in range(len(texts) if m else 0):
                own = scanned(texts[i].as_py())
                begins.append(ends + 1)  # END before each document, so its first sentence has the next number
                tokens.append(END)
                tokens += own
                ends += 1 + own.count(END)
                if len(tokens) > 200_000:
                    flush(first, tokens, begins)
                    first, tokens, begins, ends = i + 1, [], [], 0
            if begins:
                flush(first, tokens, begins)
            at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            told_names = np.array(m.names, object)[np.concatenate(found)] if rows else []
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array(told_names, pa.string())], names=["doc_id", "subject"])

    return documents.select("doc_id", "text").mapInArrow(judge, f"doc_id {kind.simpleString()}, subject string")
