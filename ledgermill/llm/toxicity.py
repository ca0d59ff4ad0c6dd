"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two words counts their common subsequences of three characters, each weighted by its gaps (up to ``GAPS``
places between neighbours), and is normalised; word ends are characters too. Insults with inserted or dropped characters
share most subsequences with the plain ones. A sentence is as toxic as its most telling word, and a document as its most
toxic sentence.

Training, on a bounded sample of labelled documents (``SAMPLE``, by hash): the label belongs to a document,
so the sentence that earns it is found along the way. Words of the sampled documents are ranked by how much commoner their
subsequences are in toxic ones; those whose like explain the most toxic documents, and common words of clean ones, become
landmarks. The
kernel to the landmarks, whitened by the landmarks' own kernel (Nyström), gives the features of a linear support vector
machine. It is fitted in rounds: toxic sentences are represented by their best word under the last model, clean ones by all
their worst. A logistic curve turns the decision value into a score.

The decision is linear in a word's subsequences, so the model is one weight for each of 2**18 subsequence codes (1 MB): a
document costs a lookup for each word, a new word a lookup for each of its subsequences. No shuffle of texts. The sample,
``sum(SAMPLE)`` documents' distinct words, is what the driver holds.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.linear import fit_logistic, fit_svm, sigmoid
from ledgermill.llm.text import give_back

#: Labelled documents in the training sample (not toxic, toxic), and landmarks of each kind.
SAMPLE, LANDMARKS = (800, 400), 48
GAPS, DECAY, ROUNDS = 3, 0.6, 4
#: Kernel values from which two words may count as alike.
ALIKE = (0.4, 0.5, 0.6, 0.7, 0.8, 0.95)
#: Word scores that a worker remembers.
REMEMBERED = 150_000
_CODES = 1 << 18
_SEPARATORS = re.compile(r"[\W_]+")
_SPELLED = re.compile(r"(?<!\S)\w(?:[\s.*_-]+\w){2,}(?!\w)")
_LOWEST = -3.0


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes (1 to 63) of words with both ends marked, end to end, and the word of each."""
    raw = "".join(f"^{w}$" for w in words)
    code = np.frombuffer(raw.encode("utf-32-le"), np.uint32).astype(np.int64)
    kind = np.where((code >= 97) & (code <= 122), code - 96, 30 + code % 34)
    kind[(code >= 48) & (code <= 57)] = 29
    ends = np.cumsum([len(w) + 2 for w in words])
    first = ends - np.array([len(w) + 2 for w in words])
    kind[first], kind[ends - 1] = 27, 28
    return kind, np.repeat(np.arange(len(words)), np.diff(np.append(0, ends)))


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, code, weight): the gapped subsequences of three characters, summed by word and code, of length 1 by word."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    kind, owner = _letters(words)
    keys, weights = [], []
    for g1 in range(1, GAPS + 1):
        for g2 in range(1, GAPS + 1):
            n = len(kind) - g1 - g2
            if n > 0:
                inside = owner[:n] == owner[g1 + g2 :]
                code = (kind[:n] << 12) | (kind[g1 : g1 + n] << 6) | kind[g1 + g2 :]
                key = (owner[:n] * _CODES + code)[inside]
                keys.append(key)
                weights.append(np.full(len(key), DECAY ** (g1 + g2 - 2)))
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    keys, back = np.unique(keys, return_inverse=True)
    weights = np.bincount(back, weights, len(keys))
    owner, code = keys // _CODES, keys % _CODES
    norm = np.sqrt(np.bincount(owner, weights**2, len(words)))
    return owner, code, weights / norm[owner]


def words_of(text: str) -> list[str]:
    """Raw words of a text, lower case, and spelled-out runs of single letters as one word each."""
    text = text.lower()
    found = text.split()
    if _SPELLED.search(text):
        found += [_SEPARATORS.sub("", m[0]) for m in _SPELLED.finditer(text)]
    return found


def clean(word: str) -> str:
    return word if word.isalpha() else _SEPARATORS.sub("", word)


class Model:
    """Weight of each subsequence code, intercept, and slope and intercept of the score curve."""

    def __init__(self, table: np.ndarray, bias: float, slope: float, offset: float):
        self.table, self.bias, self.slope, self.offset = table, bias, slope, offset

    def decisions(self, words: list[str]) -> np.ndarray:
        """The machine's value of each word."""
        out = np.full(len(words), _LOWEST)
        for a in range(0, len(words), 4096):
            part = words[a : a + 4096]
            pieces, of = [], []
            for i, w in enumerate(part):  # a long string is looked at in overlapping stretches
                for at in range(0, max(1, len(w) - 12), 24):
                    pieces.append(w[at : at + 36])
                    of.append(i)
            owner, code, weight = subsequences(pieces)
            value = np.bincount(owner, weight * self.table[code], len(pieces)) + self.bias
            np.maximum.at(out[a : a + len(part)], of, value)
        return out

    def scores(self, values: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * values + self.offset)


def is_held_out(key: Column) -> Column:
    """Rows that training never sees."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_words(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> tuple[list, list]:
    """Distinct words of the sampled documents: of the toxic ones, of the others."""
    labels = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~is_held_out(F.col(key)))
    labels = labels.groupBy(F.col(key).alias("id")).agg(F.max(label).cast("int").alias("label"))
    picked = [labels.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE[y]) for y in (0, 1)]
    picked = [tuple(r) for part in picked for r in part.collect()]
    if not picked:
        return [], []
    wanted = F.broadcast(docs.sparkSession.createDataFrame(picked, "id long, label int"))  # at most sum(SAMPLE) rows
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(wanted, "id")

    def distinct(batches):
        for batch in batches:
            words = [sorted({clean(w) for w in words_of(t.as_py())} - {""}) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(words, pa.list_(pa.string()))], names=["id", "label", "words"])

    rows = rows.select("id", "label", "text").mapInArrow(distinct, "id long, label int, words array<string>").collect()
    rows.sort(key=lambda r: (r["id"], r["words"]))
    return [r["words"] for r in rows if r["label"] == 1], [r["words"] for r in rows if r["label"] == 0]


def train(toxic: list[list[str]], other: list[list[str]], prior: float = 0.15) -> Model:
    """A model from the words of toxic and other documents. Without both kinds it calls nothing toxic."""
    toxic, other = [d for d in toxic if d], [d for d in other if d]
    if not toxic or not other:
        return Model(np.zeros(_CODES), 0.0, 1.0, -5.0)
    words = sorted({w for d in toxic + other for w in d})
    number = {w: i for i, w in enumerate(words)}
    bags = [np.array([number[w] for w in d]) for d in toxic + other]
    n, m = len(toxic), len(other)
    in_toxic = np.bincount(np.concatenate(bags[:n]), minlength=len(words))
    in_other = np.bincount(np.concatenate(bags[n:]), minlength=len(words))
    parts = []
    for a in range(0, len(words), 4096):
        owner, code, weight = subsequences(words[a : a + 4096])
        parts.append((a, owner.astype(np.int32), code.astype(np.int32), weight.astype(np.float32)))
    # how much commoner a word's subsequences are in toxic documents, counted by documents
    p, q = np.zeros(_CODES), np.zeros(_CODES)
    for a, owner, code, weight in parts:
        p += np.bincount(code, weight * in_toxic[a + owner], _CODES)
        q += np.bincount(code, weight * in_other[a + owner], _CODES)
    ratio = np.log((p / n + 1e-3) / (q / m + 1e-3))
    value = _summed(parts, ratio, len(words)) / _summed(parts, np.ones(_CODES), len(words))
    value += 0.5 * np.log((in_toxic + 0.5) / (n + 1) / ((in_other + 0.5) / (m + 1)))
    # a word that clean documents use as well cannot be what makes a document toxic
    may = in_other / m <= 0.1 * in_toxic / n
    bags = [bag[may[bag]] for bag in bags[:n]] + bags[n:]
    known = [i for i in range(n) if len(bags[i])]
    if not known:
        return Model(np.zeros(_CODES), 0.0, 1.0, -5.0)
    # landmarks: words whose like explain the most toxic documents, and common words of clean documents
    tops = np.concatenate([bags[i][np.argsort(-value[bags[i]], kind="stable")[:3]] for i in known])
    tops, times = np.unique(tops, return_counts=True)
    tops = tops[np.lexsort((tops, -value[tops], -times))][: 3 * LANDMARKS]
    like = _kernel(parts, [words[i] for i in tops], len(words))
    nearest = np.array([like[bag].max(axis=0) if len(bag) else np.zeros(len(tops), np.float16) for bag in bags])
    # each candidate reaches as far as clean documents allow
    reach = np.full(len(tops), 2.0)
    for level in ALIKE:
        near = nearest >= level
        rare = near[n:].sum(axis=0) / m <= 0.1 * near[:n].sum(axis=0) / n
        reach = np.where((reach > 1) & rare, level, reach)
    explains = nearest >= reach
    open_, marks = np.ones(n), []
    while len(marks) < LANDMARKS:
        gain = (explains[:n] * open_[:, None]).sum(axis=0)
        gain[marks] = 0
        best = int(np.argmax(gain))
        if gain[best] < (1.5 if n >= 50 else 0.4):  # what only one of many documents has explains nothing
            break
        marks.append(best)
        open_ *= np.where(explains[:n, best], 0.5, 1.0)
    if not marks:
        marks = [0]
    hit = (like[:, marks] >= reach[marks]).any(axis=1)
    del like, nearest, explains
    value = value + 100.0 * hit
    known = [i for i in known if hit[bags[i]].any()] or known
    common = [i for i in np.argsort(-in_other, kind="stable")[: 4 * LANDMARKS].tolist() if not hit[i]]
    chosen = [int(tops[i]) for i in marks] + common[:: max(1, len(common) // LANDMARKS)][:LANDMARKS]
    line, landmark = _table([words[i] for i in chosen])
    size, axes = np.linalg.eigh((landmark.T @ landmark).astype(float))
    whiten = axes / np.sqrt(np.maximum(size, 1e-6)) * (size > 1e-6)
    spread = np.flatnonzero(in_other)[:: max(1, int((in_other > 0).sum()) // 4000)]
    sure = 50.0
    for _ in range(ROUNDS):
        yes = np.unique(np.concatenate([bags[i][(value[bags[i]] >= sure) | (value[bags[i]] == value[bags[i]].max())] for i in known]))
        worst = [bag[np.argsort(-value[bag], kind="stable")[:3]] for bag in bags[n:]]
        no = np.setdiff1d(np.union1d(np.concatenate(worst), spread), yes)
        rows = np.concatenate([yes, no])
        owner, code, weight = subsequences([words[i] for i in rows])
        x = np.zeros((len(rows), len(chosen)))
        for a in range(0, len(rows), 1024):
            here = slice(*np.searchsorted(owner, [a, a + 1024]))
            np.add.at(x, owner[here], landmark[line[code[here]]] * weight[here, None])
        x = x @ whiten
        cost = np.concatenate([np.full(len(yes), 1.0 / len(yes)), np.full(len(no), 4.0 / len(no))]) * 2000
        w = fit_svm(x, np.concatenate([np.ones(len(yes)), -np.ones(len(no))]), cost)
        table = (landmark.astype(float) @ (whiten @ w[:-1]))[line]
        value = _summed(parts, table, len(words)) + w[-1]
        sure = 0.5
        known = [i for i in range(n) if len(bags[i]) and value[bags[i]].max() > -0.5] or known
    best = np.array([value[bag].max() if len(bag) else _LOWEST for bag in bags])
    truth = np.concatenate([np.ones(n), np.zeros(m)])
    weights = np.concatenate([np.full(n, prior / n), np.full(m, (1 - prior) / m)]) * len(bags)
    slope, offset = fit_logistic(best[:, None], truth, weights, ridge=0.05)
    return Model(table, float(w[-1]), float(max(slope, 0.1)), float(offset))


def _summed(parts, table: np.ndarray, n: int) -> np.ndarray:
    """Sum of a table's weights over each word's subsequences."""
    out = np.zeros(n)
    for a, owner, code, weight in parts:
        end = min(n, a + 4096)
        out[a:end] = np.bincount(owner, weight * table[code], end - a)
    return out


def _table(others: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence weights of some words, a line for each code that occurs and an empty one; and the line of each code."""
    owner, code, weight = subsequences(others)
    used, at = np.unique(code, return_inverse=True)
    line = np.full(_CODES, len(used), np.int32)
    line[used] = np.arange(len(used))
    table = np.zeros((len(used) + 1, len(others)), np.float32)
    table[at, owner] = weight
    return line, table


def _kernel(parts, others: list[str], n: int) -> np.ndarray:
    """Kernel of each word with some others."""
    line, table = _table(others)
    out = np.zeros((n, len(others)), np.float16)
    for a, owner, code, weight in parts:
        for b in range(0, 4096, 512):
            here = slice(*np.searchsorted(owner, [b, b + 512]))
            if here.start < here.stop:
                starts = np.flatnonzero(np.r_[True, np.diff(owner[here]) != 0])
                rows = table[line[code[here]]] * weight[here, None]
                out[a + owner[here][starts]] = np.add.reduceat(rows, starts)
    return out


_known: dict[int, tuple[object, dict[str, float]]] = {}


def _scorer(shared):
    """Scores of texts under a broadcast model; a worker remembers the values of words until ``forget``."""

    def score(texts: list[str]) -> np.ndarray:
        if id(shared) not in _known:
            _known.clear()
            _known[id(shared)] = (shared, {})
        known = _known[id(shared)][1]
        model = shared.value
        found = [words_of(t) for t in texts]
        fresh = list(set().union(*found).difference(known))
        if len(known) + len(fresh) > REMEMBERED:
            known.clear()
            fresh = list(set().union(*found))
        known.update(zip(fresh, model.decisions([clean(w) for w in fresh]).tolist()))
        return model.scores(np.array([max(map(known.__getitem__, words), default=_LOWEST) for words in found]))

    return score


def forget() -> None:
    """At the end of a task: a worker that waits or does other work holds no words."""
    _known.clear()
    give_back()


def _runs(column, most: int = 2 << 20):
    """(first row, texts) of runs of rows with about ``most`` characters; nulls count as empty."""
    texts, held, first = [], 0, 0
    for i, x in enumerate(column):
        texts.append(x.as_py() or "")
        held += len(texts[-1])
        if held >= most or i == len(column) - 1:
            yield first, texts
            texts, held, first = [], 0, i + 1


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"):
    """The broadcast model learned from the labelled rows that are not held out."""
    return docs.sparkSession.sparkContext.broadcast(train(*training_words(docs, labels, key, text, label)))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted) per row: the score of the whole text, and 1 where it is at least 0.5.

    Scores look at the text alone. A null text is empty and scores like a text without words. Rows with a null doc_id are
    scored and count as not held out; repeated rows score alike. Labels other than 0 and 1 are not used; of several labels
    of a doc_id the larger one counts. Without labels of both kinds every score is low.
    """
    of = _scorer(fitted(docs, labels, key, text, label))

    def run(batches):
        for batch in batches:
            for first, texts in _runs(batch.column(2)):
                values = of(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(values),
                     pa.array((values >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
        forget()

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), is_held_out(F.col(key)).alias("held_out"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """The documents, all columns, that the model does not call toxic."""
    of = _scorer(fitted(docs, labels, key, text, label))
    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            for first, texts in _runs(batch.column(place)):
                yield batch.slice(first, len(texts)).filter(pa.array(of(texts) < 0.5))
        forget()

    return docs.mapInArrow(run, docs.schema)
