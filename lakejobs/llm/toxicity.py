"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are of documents. Tokens of the training sample are labelled by the words
and word beginnings that set toxic documents apart; the field is trained on those
labelled tokens; the marginals of all tokens of a whole text then give its spans
and, through a logistic fit on the sample, its score.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import without

TOKENS = re.compile(r"[^\W\d_]+")
#: Bound of the labelled sample the model is fitted on, by class; everything else reads all rows.
SAMPLE_DOCS = 3000
#: Tokens of that sample the field itself is trained on; labelling tokens and the fit of scores use all of it.
CHAIN_TOKENS = 500_000
#: Hashed features.
SLOTS = 1 << 18
#: Steps of a chain that are multiplied together; chains are cut there and joined exactly.
CHUNK = 64
#: Chunks opened at a time: beside a few numbers a token, memory doesn't follow the number of tokens.
SLAB = 1024
#: Tokens whose chains are computed at a time.
GROUP_TOKENS = 400_000
CACHE_WORDS = 300_000
#: Occurrences of a feature in one document that count when token labels are chosen.
MOST_IN_A_DOCUMENT = 3


def features(word: str) -> list[str]:
    """The word, its beginnings of 3 to 7 letters and its last 3 letters."""
    return ["w:" + word, *[f"p:{word[:n]}" for n in range(3, 8) if len(word) >= n], "s:" + word[-3:]]


def slots(word: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) & (SLOTS - 1) for f in features(word)]


def words_of(text: str | None) -> list[str]:
    return TOKENS.findall((text or "").lower())


@dataclass
class Field:
    """Weights of the toxic state against the clean one, transitions (from, to) and starts, in logarithms."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS))
    transition: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    #: Logistic fit of a document: constant, log expected toxic tokens, highest marginal, share of toxic tokens.
    document: np.ndarray = field(default_factory=lambda: np.array([-2.0, 0.0, 0.0, 0.0]))


def marginals(emission: np.ndarray, begins: np.ndarray, model: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over chains laid end to end: (p(toxic), pair sums, start sums, log norm).

    A step is a 2 x 2 matrix; a first token has one that forgets what was before, so
    one long product holds all chains. Chunks of steps are multiplied side by
    side, the chunks joined one after the other, and then opened again.
    """
    n = len(emission)
    count = max(1, -(-n // CHUNK))
    move, begin = np.exp(model.transition), np.exp(model.start)
    slabs = [(at, min(at + SLAB, count)) for at in range(0, count, SLAB)]

    def steps(first: int, last: int) -> np.ndarray:
        here = slice(first * CHUNK, min(n, last * CHUNK))
        step = np.zeros(((last - first) * CHUNK, 2, 2))
        size = max(0, here.stop - here.start)
        step[size:] = np.eye(2)
        step[:size] = move
        step[:size][begins[here]] = begin
        step[:size, :, 1] *= np.exp(np.clip(emission[here], -30, 30))[:, None]
        return step.reshape(last - first, CHUNK, 2, 2)

    whole = np.tile(np.eye(2), (count, 1, 1))
    for first, last in slabs:
        step, product = steps(first, last), whole[first:last]
        for j in range(CHUNK):
            product = np.einsum("cik,ckj->cij", product, step[:, j])
            product /= product.sum(axis=(1, 2), keepdims=True)
        whole[first:last] = product
    enter, leave = np.empty((count, 2)), np.empty((count, 2))
    a0 = a1 = b0 = b1 = 0.5
    flat = whole.reshape(count, 4)
    for c, w in enumerate(map(np.ndarray.tolist, flat)):
        enter[c] = a0, a1
        x, y = a0 * w[0] + a1 * w[2], a0 * w[1] + a1 * w[3]
        a0, a1 = x / (x + y), y / (x + y)
    for c in range(count - 1, -1, -1):
        leave[c] = b0, b1
        w = flat[c].tolist()
        x, y = w[0] * b0 + w[1] * b1, w[2] * b0 + w[3] * b1
        b0, b1 = x / (x + y), y / (x + y)

    toxic, scale = np.empty(count * CHUNK), np.empty((count, CHUNK))
    pairs, starts = np.zeros((2, 2)), np.zeros(2)
    for first, last in slabs:
        step = steps(first, last)
        forward, before, backward = (np.empty((last - first, CHUNK, 2)) for _ in range(3))
        state = enter[first:last]
        for j in range(CHUNK):
            before[:, j] = state
            state = np.einsum("ck,ckj->cj", state, step[:, j])
            scale[first:last, j] = state.sum(axis=1)
            state = state / scale[first:last, j, None]
            forward[:, j] = state
        state = leave[first:last]
        for j in range(CHUNK - 1, -1, -1):
            backward[:, j] = state
            state = np.einsum("cij,cj->ci", step[:, j], state)
            state = state / state.sum(axis=1, keepdims=True)
        here = slice(first * CHUNK, min(n, last * CHUNK))
        fresh = begins[here]
        size = len(fresh)
        both = (forward * backward).reshape(-1, 2)[:size]
        both /= both.sum(axis=1, keepdims=True)
        pair = before[:, :, :, None] * step * backward[:, :, None, :]
        pair = (pair / pair.sum(axis=(2, 3), keepdims=True)).reshape(-1, 2, 2)[:size]
        toxic[first * CHUNK:first * CHUNK + size] = both[:, 1]
        pairs = np.add.reduce(np.concatenate((pairs[None], pair[~fresh])), axis=0)
        starts = np.add.reduce(np.concatenate((starts[None], both[fresh])), axis=0)
    return toxic[:n], pairs, starts, np.log(scale).reshape(-1)[:n].sum()


def _signature(words: list[str]) -> int:
    """Smallest hash of five-word runs: near copies mostly share it, so they count once."""
    runs = [" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))]
    return min(zlib.crc32(r.encode("utf-8", "surrogatepass")) for r in runs)


def _encoded(texts: Iterable[str | None], toxic: list[int]) -> tuple[list[np.ndarray], list[int], list[str]]:
    """Texts as numbers of their words, their labels, and the words; of near copies with one label the first stays."""
    numbers: dict[str, int] = {}
    seen: set[tuple[int, int]] = set()
    docs, labels = [], []
    for text, label in zip(texts, toxic):
        words = words_of(text)
        if words and (mark := (_signature(words), label)) not in seen:
            seen.add(mark)
            docs.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int32, len(words)))
            labels.append(label)
    return docs, labels, list(numbers)


def token_labels(docs: list[np.ndarray], toxic: list[int], names: list[str], least_docs: int = 4, lift: float = 12.0) -> set[str]:
    """Features that mark toxic tokens: of the features far more frequent in toxic documents, those that explain most.

    Documents explained by a chosen feature no longer count, so words that merely
    stand beside toxic ones are not chosen. ``docs`` hold places in ``names``.
    """
    bad = [i for i, t in enumerate(toxic) if t]
    # Words are numbered by their places, beginnings behind them; only beginnings of toxic documents can be chosen.
    in_bad = np.zeros(len(names), bool)
    for i in bad:
        in_bad[docs[i]] = True
    begun: dict[str, int] = {}
    table = np.full((len(names), 5), -1, np.int32)
    for word in np.flatnonzero(in_bad).tolist():
        for n in range(3, min(7, len(names[word])) + 1):
            table[word, n - 3] = len(names) + begun.setdefault(names[word][:n], len(begun))
    for word in np.flatnonzero(~in_bad).tolist():
        for n in range(3, min(7, len(names[word])) + 1):
            if (place := begun.get(names[word][:n])) is None:
                break
            table[word, n - 3] = len(names) + place
    beginnings = list(begun)
    del begun

    def counted(words: np.ndarray, known: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Features of a document and how often each counts."""
        own, times = np.unique(words, return_counts=True)
        found = np.concatenate((own[:, None], table[own]), axis=1).reshape(-1)
        ok = found >= 0
        if known is not None:
            ok[ok] = known[found[ok]]
        found, place = np.unique(found[ok], return_inverse=True)
        return found, np.minimum(np.bincount(place, np.repeat(times, 6)[ok], len(found)), MOST_IN_A_DOCUMENT).astype(np.int64)

    size = len(names) + len(beginnings)
    often, clean, in_docs = np.zeros((2, size), np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
    held: list[np.ndarray] = []
    for i in bad:
        found, times = counted(docs[i], None)
        often[1][found] += times
        in_docs[found] += 1
        held.append(found)
    # Only features of enough toxic documents can be chosen, so only they are counted in clean ones.
    known = in_docs >= least_docs
    for i, words in enumerate(docs):
        if not toxic[i]:
            found, times = counted(words, known)
            often[0][found] += times
            clean[found] += 1
    n_bad, n_clean = max(1, len(bad)), max(1, len(docs) - len(bad))
    # Clean texts hold the same word beginnings by chance, but once: occurrences tell more than documents.
    known &= ((often[1] + 0.5) / (n_bad + 1)) / ((often[0] + 0.5) / (n_clean + 1)) >= lift
    called = {f: "w:" + names[f] if f < len(names) else "p:" + beginnings[f - len(names)] for f in np.flatnonzero(known).tolist()}
    good: dict[str, set[int]] = {f: set() for f in called.values()}
    for i, found in zip(bad, held):
        for f in found[known[found]].tolist():
            good[called[f]].add(i)
    clean = {name: int(clean[f]) for f, name in called.items()}
    chosen: set[str] = set()
    left = set(bad)
    gain = {f: len(ids) for f, ids in good.items()}
    while gain:
        best = max(gain, key=lambda f: (gain[f] - 3 * clean[f] * n_bad / n_clean, -len(f), f))
        covered = good[best] & left
        if len(covered) < least_docs:
            if gain[best] <= len(covered) or len(covered) == 0:
                del gain[best]
                continue
            gain[best] = len(covered)
            continue
        if gain[best] != len(covered):
            gain[best] = len(covered)
            continue
        chosen.add(best)
        left -= covered
        del gain[best]
    # Features of the same strength beside the chosen ones: frequent in toxic documents, never in clean ones.
    chosen |= {f for f, ids in good.items() if clean[f] == 0 and len(ids) >= max(5 * least_docs, n_bad // 50)}
    return chosen


def _fit_chains(model: Field, docs: list[np.ndarray], labels: list[int], names: list[str], marks: set[str], rounds: int, rate: float, l2: float) -> None:
    """Adam on the exact gradient of the likelihood of the token labels."""
    # Only words of these documents, in the order in which they come.
    _, at, flat = np.unique(words := np.concatenate(docs), return_index=True, return_inverse=True)
    order = np.argsort(at)
    names = [names[w] for w in words[at[order]].tolist()]
    flat = np.argsort(order)[flat]
    sizes = np.array([len(w) for w in docs])
    begins = np.zeros(len(flat), dtype=bool)
    begins[np.concatenate(([0], np.cumsum(sizes)[:-1]))] = True
    marked = np.array([any(f in marks for f in features(w)) for w in names])
    truth = marked[flat] & np.repeat(np.array(labels, bool), sizes)
    place, count = array("q"), array("q")
    for w in names:
        found = slots(w)
        place.extend(found)
        count.append(len(found))
    place, owner = np.array(place), np.repeat(np.arange(len(names)), count)
    gold_types = np.bincount(flat, truth, len(names))
    previous = np.concatenate(([False], truth[:-1]))
    gold_pair = np.array([[np.sum(~begins & (previous == i) & (truth == j)) for j in (0, 1)] for i in (0, 1)], float)
    gold_start = np.array([np.sum(begins & ~truth), np.sum(begins & truth)], float)
    # Transitions and starts begin at the labels' frequencies and are fitted together with the weights.
    model.transition = np.log((gold_pair + 1) / (gold_pair + 1).sum(axis=1, keepdims=True))
    model.start = np.log((gold_start + 1) / (gold_start + 1).sum())
    theta = [model.weights, model.transition, model.start]
    means, squares = [np.zeros_like(t) for t in theta], [np.zeros_like(t) for t in theta]
    for turn in range(1, rounds + 1):
        per_type = np.bincount(owner, model.weights[place], len(names))
        p, pair, first, _ = marginals(per_type[flat], begins, model)
        slope = gold_types - np.bincount(flat, p, len(names))
        grads = [np.bincount(place, slope[owner], SLOTS) - l2 * model.weights, gold_pair - pair, gold_start - first]
        for t, g, m, s in zip(theta, grads, means, squares):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            t += rate * (m / (1 - 0.9**turn)) / (np.sqrt(s / (1 - 0.99**turn)) + 1e-6) / (1 if t is model.weights else 10)


def _groups(docs: Iterable[list[str]] | Iterable[np.ndarray]) -> Iterator[list]:
    group: list = []
    size = 0
    for words in docs:
        group.append(words)
        size += len(words)
        if size >= GROUP_TOKENS:
            yield group
            group, size = [], 0
    if group:
        yield group


def train(texts: Iterable[str | None], toxic: list[int], rounds: int = 40, rate: float = 0.3, l2: float = 0.1) -> Field:
    """Fit the field on token labels by Adam on the exact gradient, then the score of documents by Newton steps."""
    model = Field()
    docs, labels, names = _encoded(texts, toxic)
    if not docs or not any(labels) or all(labels):
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        model.document = np.array([np.log(share / (1 - share)), 0.0, 0.0, 0.0])
        model.start[:] = model.transition[:, :] = np.log([0.999, 0.001])
        return model
    marks = token_labels(docs, labels, names)
    chosen, size = [], 0
    for i in np.random.default_rng(0).permutation(len(docs)).tolist():
        if size < CHAIN_TOKENS:
            chosen.append(i)
            size += len(docs[i])
    _fit_chains(model, [docs[i] for i in chosen], [labels[i] for i in chosen], names, marks, rounds, rate, l2)
    emission = np.fromiter((_word_emission(w, model.weights) for w in names), float, len(names))
    x = np.concatenate([_marked(emission[np.concatenate(g)], np.array([len(d) for d in g]), model)[1] for g in _groups(docs)])
    y = np.array(labels, float)
    beta = np.zeros(4)
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (q * (1 - q))[:, None]).T @ x + np.diag([1e-3, 0.05, 0.05, 0.05])
        beta += np.linalg.solve(hessian, x.T @ (y - q) - np.array([1e-3, 0.05, 0.05, 0.05]) * beta)
    model.document = beta
    return model


def _document_features(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sizes), 4))
    out[:, 0] = 1
    full = np.flatnonzero(sizes)
    if len(full):
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))[full]
        mass = np.add.reduceat(p, starts)
        out[full, 1] = np.log1p(mass)
        out[full, 2] = np.maximum.reduceat(p, starts)
        out[full, 3] = mass / sizes[full]
    return out


def _word_emission(word: str, weights: np.ndarray) -> float:
    return float(sum(weights[s] for s in slots(word)))


def _marked(emission: np.ndarray, sizes: np.ndarray, model: Field) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of documents' tokens laid end to end, and features of the documents."""
    ends = np.cumsum(sizes)
    p = np.empty(0)
    if len(emission):
        begins = np.zeros(len(emission), dtype=bool)
        begins[(ends - sizes)[sizes > 0]] = True
        p, *_ = marginals(emission, begins, model)
    return p, _document_features(p, sizes)


class Scorer:
    """Applies a field to whole texts; word scores are kept from text to text up to a bound."""

    def __init__(self, model: Field):
        self.model, self.known = model, {}

    def _emission(self, words: list[str]) -> list[float]:
        known, weights = self.known, self.model.weights
        out = []
        for w in words:
            value = known.get(w)
            if value is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                value = known[w] = _word_emission(w, weights)
            out.append(value)
        return out

    def document_features(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all tokens end to end, features of the documents, and their numbers of tokens."""
        held = [self._emission(w) for w in words]
        sizes = np.array([len(h) for h in held], dtype=np.int64)
        return *_marked(np.concatenate([np.array(h, dtype=float) for h in held]), sizes, self.model), sizes

    def __call__(self, texts: list[str | None]) -> list[tuple[float, list[dict]]]:
        """(score, offending offsets in code points) of each text."""
        out: list[tuple[float, list[dict]]] = []
        at = 0
        for group in _groups(words_of(t) for t in texts):
            p, x, sizes = self.document_features(group)
            scores = 1 / (1 + np.exp(-np.clip(x @ self.model.document, -30, 30)))
            ends = np.cumsum(sizes)
            for text, start, end, score in zip(texts[at:], ends - sizes, ends, scores.tolist()):
                hot = np.flatnonzero(p[start:end] >= 0.5)
                out.append((score, _offsets(text, hot) if len(hot) else []))
            at += len(group)
        return out


def _offsets(text: str, tokens: np.ndarray) -> list[dict]:
    """Spans of these tokens; neighbours are one span. Words are counted as in the lower-cased text."""
    wanted = set(tokens.tolist())
    lowered = text.lower()
    same = len(lowered) == len(text)
    spans: list[dict] = []
    last = -2
    for i, m in enumerate(TOKENS.finditer(lowered)):
        if i in wanted:
            start, end = m.span() if same else (_place(text, m.start()), _place(text, m.end()))
            if i == last + 1:
                spans[-1]["end"] = end
            else:
                spans.append({"start": start, "end": end})
            last = i
    return spans


def _place(text: str, at: int) -> int:
    """Position in ``text`` of a position in its lower-cased form, where letters grew by lowering."""
    seen = 0
    for i, c in enumerate(text):
        if seen >= at:
            return i
        seen += len(c.lower())
    return len(text)


def learns(key: Column) -> Column:
    """Whether labels of this row may be learned from: crc32 of the key as text is no multiple of five."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample_docs: int = SAMPLE_DOCS, seed: int = 0) -> Field:
    """Train on at most about ``sample_docs`` labelled texts of each class, picked by a seeded hash of the key.

    Keys are picked first, so only the texts of the sample come to the driver. A key
    with several labels is toxic if one of them is; null labels and keys teach nothing.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("label_key")).agg(
        F.max(label).cast("int").alias("label"))
    known = known.where(learns(F.col("label_key")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, F.lit(min(1.0, sample_docs / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.lit(seed), "label_key"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = known.where(drawn < share)
    rows = docs.select(F.col(key), F.col(text).alias("text")).join(
        F.broadcast(sample), F.col(key) == F.col("label_key")).select("label_key", "text", "label")
    # Repeated rows of a sampled key could be many: one of each key is enough to learn from.
    one = rows.groupBy("label_key", "label").agg(F.min("text").alias("text"))
    found = sorted(one.collect(), key=lambda r: r["label_key"], reverse=True)
    marked = [r["label"] for r in reversed(found)]
    return train((found.pop()["text"] for _ in marked), marked)  # a text is let go when its words are known


def score(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from 0.5) and ``toxic_spans`` (start, end).

    Offsets are code points, end exclusive. Null and empty texts get the score of a
    text without words; columns named like the new ones are replaced; repeated rows
    get equal scores; an empty table gives no rows.
    """
    docs = without(docs, "score", "predicted", "toxic_spans")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = scorer(batch.column(names.index(text)).to_pylist())
            scores = pa.array([s for s, _ in found], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores, pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array([x for _, x in found], spans)],
                names=[*names, "score", "predicted", "toxic_spans"])

    return docs.mapInArrow(run, f"{columns}, score double, predicted int, toxic_spans array<struct<start:int,end:int>>")


def accepted(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` without the rows the model rejects, with all columns as they are; texts without words stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            keep = [s < 0.5 or not words_of(t) for t, (s, _) in zip(texts, scorer(texts))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
