"""Language ID with a linear-chain conditional random field over words.

Each word of a text is labelled with a language: its features are affixes (1 to 4 bytes at either end), byte n-grams
(2 and 3) of its first and last 12 bytes (longer words, and texts without spaces, are cut between characters into
words of at most 24 bytes, so every byte is read), and a lexicon (the share of each language among a word's occurrences in the
lexicon half of the training sample), scores between neighbouring labels are learned transitions, and the
forward-backward recursion over the whole text gives every word's label probabilities. A text's language is the
one with the largest sum of probabilities over its words with letters; the score is its share.

*Training* uses a bounded sample of labelled rows: ``sample_docs`` documents with the smallest hashes, of each one
span of at most ``span_words`` words at a hashed place. Half of them make the lexicon; the others are cut in
stretches and joined to code-switched chains, on which the conditional log-likelihood is maximised by AdaGrad. The model
(hashed weights, transitions, lexicon) is of fixed size and sent to the tasks.

*Prediction* runs over all documents without a shuffle; word scores are computed once per distinct word of a
chunk, and the recursions advance all texts of the chunk together.

Defined results: null texts and texts without a letter are ``und`` with score 0; without training rows every other text
is ``und`` too; repeated rows are predicted each; null labels are not learned from. Words are cut at white space
and, if long, into parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from demand.llm.common import BASE, chunks, flat, hashed_sample, lean, mix, piece_hashes, span_index, string_array
from demand.llm.hmm import by_time, tokens

SLOTS = 1 << 16
SIDE = 12
CHUNK_BYTES = 4 << 20
UNKNOWN = "und"


# ---- features -----------------------------------------------------------------------------------------------------

def _sides(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last SIDE bytes of each word (0 outside the word), and the words' lengths."""
    data, at = flat(words)
    size = np.diff(at)
    step = np.arange(SIDE)
    last = max(len(data) - 1, 0)
    data = data if len(data) else np.zeros(1, np.uint8)
    inside = step < size[:, None]
    head = np.where(inside, data[np.minimum(at[:-1, None] + step, last)], 0)
    tail = np.where(inside, data[np.maximum(at[1:, None] - 1 - step, 0)], 0)
    return head, tail, size


def word_features(words) -> np.ndarray:
    """Hashed feature slots of each distinct word (n x number of features); slot 0 for none."""
    head, tail, size = _sides(words)
    out = []

    def add(kind: int, columns, there) -> None:
        h = np.full(len(size), kind, np.uint64)
        for c in columns:
            h = (h + c.astype(np.uint64) + np.uint64(1)) * np.uint64(BASE)
        out.append(np.where(there, mix(h) % np.uint64(SLOTS - 1) + np.uint64(1), 0).astype(np.int32))

    for n in range(1, 5):
        add(n, head[:, :n].T, size >= n)
        add(10 + n, tail[:, :n].T, size >= n)
    for n in (2, 3):  # n-grams of both ends; the two ends of a short word overlap
        for i in range(SIDE - n + 1):
            add(20 + n, head[:, i:i + n].T, size >= i + n)
        for i in range(SIDE - n + 1):
            add(20 + n, tail[:, i:i + n].T[::-1], size >= SIDE + i + n)
    return np.stack(out, axis=1)


class Tagger:
    """Feature weights (slots x labels), lexicon, and transitions of the chain."""

    def __init__(self, labels: list[str], weights, lex_hash, lex_share, lex_weight, move, start):
        self.labels, self.weights = labels, weights.astype(np.float32)
        self.lex_hash, self.lex_share, self.lex_weight = lex_hash, lex_share, lex_weight
        self.move, self.start = move, start

    def lexicon(self, words) -> np.ndarray:
        """Lexicon features of each word: the share per language of a known word, else 0."""
        out = np.zeros((len(words), len(self.labels)))
        if len(self.lex_hash) and len(words):
            h = piece_hashes(*flat(words))
            at = np.minimum(np.searchsorted(self.lex_hash, h), len(self.lex_hash) - 1)
            known = self.lex_hash[at] == h
            out[known] = self.lex_share[at[known]]
        return out

    def scores(self, words, letters: np.ndarray) -> np.ndarray:
        """Label scores of each distinct word; words without a letter say nothing."""
        out = np.zeros((len(words), len(self.labels)))
        for i in range(0, len(words), 20_000):
            part = words.slice(i, 20_000)
            out[i:i + len(part)] = self.weights[word_features(part)].sum(axis=1) + self.lexicon(part) * self.lex_weight
        return np.where(letters[:, None], out, 0.0)


def one_sided(tagger: Tagger, emitted: np.ndarray, active: np.ndarray):
    """Forward (with the word's own score) and backward (without) values of time-ordered words, each scaled to sum 1."""
    move, start = np.exp(tagger.move), np.exp(tagger.start)
    left, right, at, last = np.empty_like(emitted), np.empty_like(emitted), 0, None
    for m in active.tolist():
        a = emitted[at:at + m] * (start if last is None else last[:m] @ move)
        a /= a.sum(axis=1, keepdims=True)
        left[at:at + m] = a
        last, at = a, at + m
    ahead, end = None, len(emitted)
    for m in active[::-1].tolist():
        at = end - m
        now = np.ones((m, emitted.shape[1]))
        if ahead is not None:
            now[:len(ahead)] = ahead @ move.T
        now /= now.sum(axis=1, keepdims=True)
        right[at:end] = now
        ahead, end = emitted[at:end] * now, at
    return left, right


def marginals(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Label probabilities of each word."""
    both = left * right
    return both / both.sum(axis=1, keepdims=True)


# ---- training ----------------------------------------------------------------------------------------------------

def training_sample(docs: DataFrame, label: str, sample_docs: int, span_words: int):
    """(label, words) of a bounded sample, by hash of the row."""
    labelled = docs.where(F.col("text").isNotNull() & F.col(label).isNotNull())
    ranked = hashed_sample(labelled, sample_docs, *docs.columns).select("text", F.col(label).cast("string").alias("label"), "h")

    def spans(batches):
        for batch in batches:
            out = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist(), strict=True):
                w = text.split()
                if any(len(x) > SIDE // 2 and len(x.encode()) > 2 * SIDE for x in w):
                    w = cut_long(pa.array(w, pa.string()))[0].to_pylist()
                at = h % max(1, len(w) - span_words + 1)
                out.append(" ".join(w[at:at + span_words]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), batch.column("label"), batch.column("h")], names=["text", "label", "h"])

    rows = ranked.mapInArrow(spans, "text string, label string, h long").toPandas().sort_values(["h", "label"])
    return rows["label"].tolist(), rows["text"].tolist()


def train(docs: DataFrame, label: str = "lang", sample_docs: int = 3000, span_words: int = 96, stretch: int = 12,
          epochs: int = 30, rate: float = 0.3, seed: int = 3) -> Tagger | None:
    """A tagger fitted on at most ``sample_docs`` x ``span_words`` words (see the module's text)."""
    labels_of, spans = training_sample(docs, label, sample_docs, span_words)
    labels = sorted(set(labels_of))
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    k = len(labels)
    y_doc = np.array([labels.index(x) for x in labels_of])
    words, number, count = parts(pa.array(spans, pa.string()))
    y, doc = np.repeat(y_doc, count), np.repeat(np.arange(len(count)), count)
    for_lexicon = (doc % 2 == 0)

    seen = np.zeros((len(words), k))
    np.add.at(seen, (number[for_lexicon], y[for_lexicon]), 1)
    total = seen.sum(axis=1)
    known = total >= 2
    hashed = piece_hashes(*flat(words)) if len(words) else np.empty(0, np.uint64)
    share = (seen[known] + 0.1) / (total[known, None] + 0.1 * k)
    order = np.argsort(hashed[known])
    tagger = Tagger(labels, np.zeros((SLOTS, k)), hashed[known][order], share[order], np.zeros(k), np.zeros((k, k)), np.zeros(k))

    # code-switched chains: stretches of the other half in random order, eight to a chain
    use = np.flatnonzero(~for_lexicon) if (~for_lexicon).any() else np.arange(len(doc))
    first = np.flatnonzero(np.concatenate([[True], np.diff(doc[use]) != 0])) if len(use) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(use)))
    cut = [(a + i, min(stretch, n - i)) for a, n in zip(first.tolist(), size.tolist(), strict=True) for i in range(0, n, stretch)]
    if not cut:
        return tagger
    rng.shuffle(cut)
    words_at = np.concatenate([use[a:a + n] for a, n in cut])
    chain = np.array([sum(n for _, n in cut[i:i + 8]) for i in range(0, len(cut), 8)])
    _, place, active = by_time(chain)
    x, gold = number[words_at][place], y[words_at][place]
    letters = _has_letter(words)
    features = word_features(words)
    lexical = tagger.lexicon(words)

    ahead = np.arange(len(x))  # place of the next word of the same chain, or -1
    starts = np.cumsum(active) - active
    step = np.repeat(np.arange(len(active)), active)
    rank = np.arange(len(x)) - starts[step]
    after = np.append(starts, len(x))[step + 1] + rank
    has_next = (step + 1 < len(active)) & (rank < np.append(active, 0)[step + 1])
    ahead = np.where(has_next, after, -1)

    theta = {"w": np.zeros((SLOTS, k)), "l": np.zeros(k), "m": np.zeros((k, k)), "s": np.zeros(k)}
    square = {n: np.full(v.shape, 1e-6) for n, v in theta.items()}
    one_hot = np.eye(k)
    moves = np.zeros((k, k))
    here = np.flatnonzero(has_next)
    np.add.at(moves, (gold[here], gold[ahead[here]]), 1)
    for _ in range(epochs):
        tagger.weights, tagger.lex_weight, tagger.move, tagger.start = theta["w"], theta["l"], theta["m"], theta["s"]
        raw = np.where(letters[:, None], theta["w"][features].sum(axis=1) + lexical * theta["l"], 0.0)
        emitted = np.exp(raw - raw.max(axis=1, keepdims=True))[x]
        left, right = one_sided(tagger, emitted, active)
        p = marginals(left, right)
        wrong = one_hot[gold] - p
        by_word = np.zeros((len(words), k))
        for j in range(k):
            by_word[:, j] = np.bincount(x, weights=wrong[:, j], minlength=len(words))
        by_word[~letters] = 0
        grad = {"w": np.zeros((SLOTS, k)), "l": (by_word * lexical).sum(axis=0), "s": wrong[:active[0]].sum(axis=0)}
        for f in features.T:
            for j in range(k):
                grad["w"][:, j] += np.bincount(f, weights=by_word[:, j], minlength=SLOTS)
        grad["w"][0] = 0
        # expected moves: pairs of neighbours, by the chain's own pair probabilities
        move = np.exp(theta["m"])
        pair = left[here][:, :, None] * move[None] * (emitted[ahead[here]] * right[ahead[here]])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        grad["m"] = moves - pair.sum(axis=0)
        for n in theta:
            g = grad[n] / len(x) - 1e-5 * theta[n]
            square[n] += g * g
            theta[n] = theta[n] + rate * g / np.sqrt(square[n])
    return Tagger(labels, theta["w"], tagger.lex_hash, tagger.lex_share, theta["l"], theta["m"], theta["s"])


def cut_long(words) -> tuple[pa.Array, np.ndarray]:
    """Words of more than 2 SIDE bytes cut between characters into parts of at most that; parts of each word."""
    data, at = flat(words)
    size = np.diff(at)
    n = np.where(size > 2 * SIDE, -(-size // (2 * SIDE - 3)), 1)
    owner = np.repeat(np.arange(len(n)), n)
    start = at[owner] + span_index(np.zeros(len(n), np.int64), n) * size[owner] // n[owner]
    for _ in range(3):
        start -= (start > at[owner]) & (data[np.minimum(start, len(data) - 1)] & 0xC0 == 0x80)
    return string_array(data, np.append(start, len(data))), n


def parts(column):
    """``tokens`` of texts with long words cut: every byte of a word is in the first or last SIDE bytes of a part."""
    words, number, count = tokens(column)
    if not len(words) or np.diff(flat(words)[1]).max() <= 2 * SIDE:
        return words, number, count
    cut, n = cut_long(words)
    coded = cut.dictionary_encode()
    text = np.repeat(np.arange(len(count)), count)
    number_of = coded.indices.to_numpy()[span_index((np.cumsum(n) - n)[number], n[number])]
    return coded.dictionary, number_of, np.bincount(text, weights=n[number], minlength=len(count)).astype(np.int64)


def _has_letter(words) -> np.ndarray:
    return pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False) if len(words) else np.empty(0, bool)


# ---- prediction ---------------------------------------------------------------------------------------------------

def predict_texts(tagger: Tagger | None, column):
    """(language, score) of each text of a column without nulls."""
    n = len(column)
    words, number, count = parts(column)
    letters = _has_letter(words)
    doc = np.repeat(np.arange(n), count)
    spoken = np.bincount(doc[letters[number]], minlength=n) if len(number) else np.zeros(n, np.int64)
    if tagger is None or not spoken.any():
        return [UNKNOWN] * n, np.zeros(n)
    raw = tagger.scores(words, letters)
    word = np.exp(raw - raw.max(axis=1, keepdims=True))
    _, place, active = by_time(count)
    p = marginals(*one_sided(tagger, word[number[place]], active))
    heard = letters[number[place]]
    total = np.stack([np.bincount(doc[place][heard], weights=p[heard, j], minlength=n) for j in range(p.shape[1])], axis=1)
    best = total.argmax(axis=1)
    score = total.max(axis=1) / np.maximum(total.sum(axis=1), 1e-300)
    known = spoken > 0
    return [tagger.labels[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, np.clip(score, 0, 1), 0.0)


def predict(docs: DataFrame, tagger: Tagger | None) -> DataFrame:
    """``docs`` with lang_pred and score; null texts stay null."""
    docs = docs.drop("lang_pred", "score")
    schema = StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # SLOTS x labels numbers and a lexicon of the sample's words

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index("text")
            whole = batch.set_column(i, "text", pc.fill_null(batch.column(i), ""))
            at = 0
            for chunk in chunks([whole], CHUNK_BYTES):
                lang, score = predict_texts(shared.value, chunk.column("text"))
                own = batch.slice(at, chunk.num_rows)
                at += chunk.num_rows
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                                 names=[*own.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(lean(run), schema)


def identify(docs: DataFrame, learn_from: Column, label: str = "lang", **options) -> DataFrame:
    """Train on the labelled rows where ``learn_from`` holds and predict every row."""
    return predict(docs, train(docs.where(F.coalesce(learn_from, F.lit(False))), label, **options))
