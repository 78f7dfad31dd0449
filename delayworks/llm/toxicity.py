"""Toxicity: a linear-chain conditional random field tags toxic spans; its marginals give document scores and offsets.

Only documents carry labels, so tokens are labelled from them first: words and stems found in toxic
documents far more often than chance allows are toxic tokens there, all other tokens are not. The chain sees of every token
its entry among those, the hashed word, its hashed beginnings and ending and its shape, and the entries of its neighbours;
what an unseen word is worth is decided by the weights of its parts. The score of a document is the marginal of its most
toxic token, calibrated on the labelled sample; the offending offsets are the runs of tokens more likely toxic than not.

Defined cases: a null or empty text has no token and gets the score of one; repeated rows get equal scores; an empty table
gives an empty result; only the named id and text columns are read. Without usable labels every score is 0.5.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayworks.llm import crf
from delayworks.llm.common import free_name, pieces, texts_of
from delayworks.llm.quality import training_rows

#: Most labelled documents of a class that label the tokens and calibrate the score. Scoring reads every row.
FIT_DOCUMENTS = 1500
#: Of those, so many of a class, drawn by the hash of their text, fit the weights of the chain.
CHAIN_DOCUMENTS = 300
#: Hashed parts of a word: beginnings of so many letters, the ending, the whole, each in a table of its own.
BEGINNINGS, ENDING, HASH_SIZE = (4, 6, 8), 3, 1 << 14
#: Documents whose features the driver holds together after the weights are fitted.
FIT_STEP = 100
STEMS = (5, 4)
THRESHOLD = 0.7
TOKEN = re.compile(r"\w+")
UNKNOWN = 0


def tokens_of(text: str) -> list[str]:
    return [w.lower() for w in TOKEN.findall(text)]


def units_of(word: str) -> tuple[str, ...]:
    """A word and its stems, written with a star."""
    return (word, *(word[:n] + "*" for n in STEMS if len(word) > n))


def token_labels(documents: list[list[str]], toxic: np.ndarray, most_false: float = 0.5) -> set[str]:
    """Words and stems whose use in toxic documents chance cannot account for.

    Uses are counted by documents and by distinct pairs of neighbouring words, whichever are fewer, so copies of a
    document and a word repeated in one document count once. Of n uses, k in
    toxic documents, chance would give a binomial k; a unit is taken while fewer than ``most_false`` units as frequent
    would reach its k, and only if it is rare in clean documents. Stems are taken only if their words vary.
    """
    bad: dict[str, set] = defaultdict(set)
    bad_in: Counter = Counter()
    clean_in: Counter = Counter()
    forms: dict[str, set] = defaultdict(set)
    tokens = [0, 0]
    for i in np.flatnonzero(toxic == 1).tolist():
        words = ["", *documents[i], ""]
        tokens[1] += len(documents[i])
        for before, word, after in zip(words, words[1:], words[2:]):
            for unit in units_of(word):
                bad[unit].add(hash((before, after)))
                forms[unit].add(word)
        bad_in.update({u for w in set(documents[i]) for u in units_of(w)})
    bad = {u: uses for u, uses in bad.items() if len(uses) >= 3 and (u[-1] != "*" or len(forms[u]) >= 3)}
    clean: dict[str, set] = {u: set() for u in bad}
    for i in np.flatnonzero(toxic == 0).tolist():
        words = ["", *documents[i], ""]
        tokens[0] += len(documents[i])
        for before, word, after in zip(words, words[1:], words[2:]):
            for unit in units_of(word):
                if unit in clean:
                    clean[unit].add(hash((before, after)))
        clean_in.update({u for w in set(documents[i]) for u in units_of(w) if u in clean})
    share = float(np.clip(tokens[1] / max(1, sum(tokens)), 1e-3, 1 - 1e-3))
    uses = {}
    for u in bad:
        k = min(len(bad[u]), bad_in[u])
        if k >= 3:
            uses[u] = (k, k + min(len(clean[u]), clean_in[u]))
    rivals = Counter(n for _, n in uses.values())
    frequent, held = {}, 0
    for n in sorted(rivals, reverse=True):
        held += rivals[n]
        frequent[n] = held
    return {u for u, (k, n) in uses.items() if n - k <= k / 8 and _tail(n, k, share) * frequent[n] < most_false}


def _tail(n: int, k: int, p: float) -> float:
    """P(Binomial(n, p) >= k)."""
    term = np.exp(_log_choose(n, k) + k * np.log(p) + (n - k) * np.log1p(-p))
    total, i = term, k
    while i < n and term > total * 1e-12:
        term *= (n - i) / (i + 1) * p / (1 - p)
        total += term
        i += 1
    return float(min(1.0, total))


def _log_choose(n: int, k: int) -> float:
    k = min(k, n - k)
    return float(np.log(np.arange(n - k + 1, n + 1)).sum() - np.log(np.arange(1, k + 1)).sum())


@dataclass
class ToxicityModel:
    chain: crf.Chain
    vocabulary: dict[str, int]  # words, and stems with a star
    slope: float
    shift: float

    def __post_init__(self):
        self.words = {w: i for w, i in self.vocabulary.items() if w[-1] != "*"}
        self.stems = [{w[:-1]: i for w, i in self.vocabulary.items() if w[-1] == "*" and len(w) == n + 1} for n in STEMS]

    def ids(self, words: list[str]) -> list[int]:
        get, (five, four) = self.words.get, (s.get for s in self.stems)
        return [get(w) or five(w[:5]) or four(w[:4], UNKNOWN) for w in words]

    def features(self, documents: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Feature slots of all tokens, their entries, and how many tokens each document has."""
        sizes = np.array([len(d) for d in documents], int)
        number: dict[str, int] = {}
        words = np.array([number.setdefault(w, len(number)) for d in documents for w in d], np.int64)
        known = list(number)
        ids = np.array(self.ids(known), np.int64)[words] if known else words
        parts = parts_of(known)
        return [*neighbours(ids, sizes, len(self.vocabulary)), *(p[words] for p in parts)], ids, sizes

    def marginals(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Marginal of every token, and how many tokens each document has."""
        slots, _, sizes = self.features(documents)
        return self.chain.marginals(slots, starts_of(sizes)), sizes

    def scores(self, documents: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, sizes = self.marginals(documents)
        return 1 / (1 + np.exp(-np.clip(self.slope * top_logit(p, sizes) + self.shift, -30, 30))), p, sizes

    def spans(self, text: str, p: np.ndarray) -> list[dict]:
        """Runs of toxic tokens as character offsets into ``text``."""
        out: list[dict] = []
        previous = -2
        for i, match in enumerate(TOKEN.finditer(text)):
            if p[i] > 0.5:
                if previous == i - 1:
                    out[-1]["end"], out[-1]["score"] = match.end(), max(out[-1]["score"], float(p[i]))
                else:
                    out.append({"start": match.start(), "end": match.end(), "score": float(p[i])})
                previous = i
        return out


def starts_of(sizes: np.ndarray) -> np.ndarray:
    starts = np.zeros(int(sizes.sum()), bool)
    begin = np.cumsum(sizes) - sizes
    starts[begin[sizes > 0]] = True
    return starts


def neighbours(ids: np.ndarray, sizes: np.ndarray, edge: int) -> list[np.ndarray]:
    """The token, the one before and the one after; ``edge + 1`` stands beyond either end of a document."""
    starts = starts_of(sizes)
    before, after = np.empty_like(ids), np.empty_like(ids)
    before[1:], after[:-1] = ids[:-1], ids[1:]
    before[starts] = edge + 1
    after[:-1][starts[1:]] = edge + 1
    after[-1:] = edge + 1
    return [ids, before, after]


def parts_of(words: list[str]) -> list[np.ndarray]:
    """Hashed beginnings, ending and whole of each word, and its shape; 0 stands for a part that the word is too short for."""
    def hashed(parts: list[str | None]) -> np.ndarray:
        return np.array([1 + zlib.crc32(p.encode("utf-8", "replace")) % (HASH_SIZE - 1) if p else 0 for p in parts], np.int64)

    shape = np.array([min(len(w), 15) + 16 * (not w.isalpha()) + 32 * (not w.isascii()) for w in words], np.int64)
    return [*(hashed([w[:n] if len(w) > n else None for w in words]) for n in BEGINNINGS),
            hashed([w[-ENDING:] if len(w) > ENDING else None for w in words]), hashed(words), shape]


PART_SIZES = [HASH_SIZE] * (len(BEGINNINGS) + 2) + [64]


def top_logit(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Log odds of each document's most toxic token; unlike a sum over tokens it does not drift with the length."""
    top = np.full(len(sizes), 1e-6)
    if len(p):
        full = sizes > 0
        top[full] = np.clip(np.maximum.reduceat(p, (np.cumsum(sizes) - sizes)[full]), 1e-6, 1 - 1e-6)
    return np.log(top / (1 - top))


def train(texts: list[str], labels: np.ndarray, chain_documents: int = CHAIN_DOCUMENTS) -> ToxicityModel:
    """Fit on whole labelled texts; the chain's weights on the first ``chain_documents`` of each class in the order of the texts' hashes."""
    labels = np.asarray(labels, int)
    if len(set(labels.tolist())) < 2:
        none = crf.Chain([np.zeros(2)] * 3 + [np.zeros(n) for n in PART_SIZES], -20.0, 0.0, np.zeros((2, 2)))
        return ToxicityModel(none, {}, 0.0, 0.0)
    pool: dict[str, str] = {}
    documents = [[pool.setdefault(w, w) for w in tokens_of(t)] for t in texts]
    toxic = token_labels(documents, labels)
    drawn = np.argsort([zlib.crc32(t.encode("utf-8", "replace")) for t in texts], kind="stable")
    few = sorted(np.concatenate([drawn[labels[drawn] == k][:chain_documents] for k in (0, 1)]).tolist())
    part, part_labels = [documents[i] for i in few], labels[few]
    known = sorted(toxic)
    model = ToxicityModel(crf.Chain([], 0.0, 0.0, np.zeros((2, 2))), {w: i for i, w in enumerate(known, start=1)}, 1.0, 0.0)
    slots, ids, sizes = model.features(part)
    is_toxic = np.array([False, *(w in toxic for w in known)])
    marks = (is_toxic[ids] & (np.repeat(part_labels, sizes) == 1)).astype(int)
    chain = crf.fit(slots, [len(known) + 2] * 3 + PART_SIZES, marks, starts_of(sizes), rounds=60, rate=0.3)
    model = ToxicityModel(chain, model.vocabulary, 1.0, 0.0)
    odds = [top_logit(*model.marginals(documents[k:k + FIT_STEP])) for k in range(0, len(documents), FIT_STEP)]
    slope, shift = crf.logistic(np.concatenate(odds), labels.astype(float))
    return ToxicityModel(chain, model.vocabulary, slope, shift)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
        most: int = FIT_DOCUMENTS, chain_documents: int = CHAIN_DOCUMENTS) -> ToxicityModel:
    """``most`` and ``chain_documents`` bound the labelled documents of a class that are learned from; both are drawn by hash."""
    return train(*training_rows(docs, labels, label, id_col, text_col, most), chain_documents)


def tag(model: ToxicityModel, text: Column | str) -> Column:
    """Struct of a whole text's score and its toxic spans (character offsets, end not included)."""

    @F.arrow_udf("score double, spans array<struct<start: int, end: int, score: double>>")
    def tagged(column: pa.Array) -> pa.Array:
        scores, spans = [], []
        for piece in pieces(column):
            texts = texts_of(piece)
            s, p, sizes = model.scores([tokens_of(t) for t in texts])
            scores.extend(s.tolist())
            ends = np.cumsum(sizes)
            hot = np.bincount(np.repeat(np.arange(len(sizes)), sizes), p > 0.5, minlength=len(sizes)) > 0
            for i, t in enumerate(texts):
                spans.append(model.spans(t, p[ends[i] - sizes[i]:ends[i]]) if hot[i] else [])
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], ["score", "spans"])

    return tagged.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows whose score stays below the threshold, with their columns."""
    name = free_name(docs, "toxicity_tags")
    return docs.withColumn(name, tag(model, text_col)).where(F.col(name)["score"] < threshold).drop(name)
