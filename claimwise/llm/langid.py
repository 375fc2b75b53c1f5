"""Language identification with segmentation-marginalised unigram models.

Every language has a probability for each piece of one fixed public vocabulary.  The probability of a word
is the sum over all ways to cut it into pieces, by the forward algorithm; the text's is the product over its
words, the language's posterior decides.  Words are runs of letters, lower-cased, with a word-start mark; the
vocabulary's pieces never cross words, so each distinct word of an Arrow batch is scored once, many at a time.

Training: expectation maximisation over the word counts of a bounded sample per language, with the
backward algorithm for the expected piece counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import LETTERS, mixed, short_batches, stored

#: Expected number of training documents per language, the bound of the labelled sample.
SAMPLE_DOCS = 1500
#: Rounds of expectation maximisation.
ROUNDS = 3
#: Words up to this length are summed in plain numbers, many at once, longer ones one by one in logarithms (plain products would vanish).
PLAIN_CHARS = 40
#: Characters of a long word whose pieces are looked up at once.
LONG_BLOCK = 1 << 16
#: Words whose log probabilities a task remembers.
KNOWN_WORDS = 450_000
#: Least log probability a letter by which a text may fall short of its language's median, and the further room of short texts in usual deviations.
ROOM, SHORT = 1.5, 8.0
MARK = "▁"
UNKNOWN = 1e-7
BASE = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_pieces(path: str) -> list[str]:
    """Letter pieces of a sentencepiece model, lower case, with or without the word-start mark."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    keep = {p for p in names if (q := p.removeprefix(MARK)) and q.isalpha() and p == p.lower() and MARK not in q}
    return sorted(keep | {MARK})


def split_words(text: str | None) -> list[str]:
    out = []
    for w in LETTERS.findall(text.lower()) if text else ():
        if w.isalpha():  # marks and numbers that count as word characters are no letters
            out.append(w)
        else:
            out += split_words("".join(c if c.isalpha() else " " for c in w))
    return out


def _chars(words: list[str], width: int) -> np.ndarray:
    data = "".join(MARK + w.ljust(width - 1, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, "<u4").reshape(len(words), width).astype(np.uint64)


class Pieces:
    """The vocabulary as a hash table of pieces, for whole arrays of words at a time."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces))
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        bits = max(16, int(np.ceil(np.log2(len(pieces) * 8))))
        self.shift = np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)  # open addressing with one probe chain
        self.keys = np.zeros(1 << bits, np.uint64)
        self.probes = 1
        for n, k in enumerate(keys):
            at, step = int(k >> self.shift), 0
            while self.slots[at] >= 0:
                at, step = (at + 1) % len(self.slots), step + 1
            self.slots[at], self.keys[at] = n, k
            self.probes = max(self.probes, step + 1)
        self.n = len(pieces)

    @staticmethod
    def _hash(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * BASE + np.uint64(ord(c))
        return int(mixed(h)[0])

    def find(self, raw: np.ndarray) -> np.ndarray:
        """Piece numbers of raw hashes, -1 where there is none."""
        k = mixed(raw)
        at = (k >> self.shift).astype(np.int64)
        out = np.full(len(k), -1, np.int32)
        for step in range(self.probes):
            i = (at + step) % len(self.slots)
            hit = (self.slots[i] >= 0) & (self.keys[i] == k)
            out[hit] = self.slots[i][hit]
        return out

    def edges(self, words: list[str], pad: int = 1) -> Iterator[tuple[np.ndarray, int, list[list[tuple[int, np.ndarray, np.ndarray]]]]]:
        """Groups of words of one length, rounded up to ``pad``: their positions, the length with the mark, and for each
        end the pieces that end there as (length, words' rows, piece numbers)."""
        sizes = -(-np.array([len(w) for w in words], np.int64) // pad) * pad
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            width = int(size) + 1
            chars = _chars([words[i] for i in rows], width)
            prefix = [np.zeros(len(rows), np.uint64)]
            for j in range(width):
                prefix.append(prefix[-1] * BASE + chars[:, j])
            power = [np.uint64(1)]
            for _ in range(self.longest):
                power.append(np.uint64((int(power[-1]) * int(BASE)) & 0xFFFFFFFFFFFFFFFF))
            ends = []
            for end in range(1, width + 1):
                found = []
                for length in range(1, min(end, self.longest) + 1):
                    ids = self.find(prefix[end] - prefix[end - length] * power[length])
                    hit = np.flatnonzero(ids >= 0)
                    if length == 1:  # an unknown character is a piece of its own, number n
                        found.append((1, np.arange(len(rows)), np.where(ids >= 0, ids, self.n)))
                    elif len(hit):
                        found.append((length, hit, ids[hit]))
                ends.append(found)
            yield rows, width, ends

    def ending(self, word: str, low: int, high: int) -> np.ndarray:
        """Pieces of a marked word that end at its places ``low`` < end <= ``high``: numbers by (length - 1, end - low - 1), -1 where there is none."""
        begin = max(0, low - self.longest)
        chars = np.frombuffer(word[begin:high].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        out = np.full((self.longest, high - low), -1, np.int32)
        rolling = np.zeros(len(chars), np.uint64)
        for length in range(1, self.longest + 1):
            # hash of the ``length`` characters that end at each place
            rolling = chars.copy() if length == 1 else np.concatenate([np.zeros(1, np.uint64), rolling[:-1]]) * BASE + chars
            ids = self.find(rolling)
            ids[:length - 1] = -1
            if length == 1:
                ids[ids < 0] = self.n
            out[length - 1] = ids[low - begin:]
        return out

    def long_forward(self, word: str, log_prob: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Of a word of any length, for each place of its end: log probability of what stands before under each language, pieces that end there."""
        word = MARK + word
        before = np.zeros((1, log_prob.shape[1]))  # of the last places, the nearest last
        for low in range(0, len(word), LONG_BLOCK):
            found = self.ending(word, low, min(len(word), low + LONG_BLOCK))
            for ids in found.T:
                lengths = np.flatnonzero(ids >= 0)
                each = before[-1 - lengths] + log_prob[ids[lengths]]
                top = each.max(axis=0)
                now = top + np.log(np.exp(each - top).sum(axis=0))
                before = np.vstack((before[-self.longest + 1:], now))
                yield now, ids

    def forward(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """log probability of each word (rows) under each language (columns); prob: pieces + 1 by languages."""
        out = np.empty((len(words), prob.shape[1]))
        short = [i for i, w in enumerate(words) if len(w) <= PLAIN_CHARS]
        if len(short) < len(words):
            log_prob = np.log(prob)
            for i in sorted(set(range(len(words))).difference(short)):
                for now, _ in self.long_forward(words[i], log_prob):
                    pass
                out[i] = now
            out[short] = self.forward([words[i] for i in short], prob)
            return out
        last = np.array([len(w) + 1 for w in words], np.int64)
        for rows, width, ends in self.edges(words, 5):  # fewer, larger arrays; what follows a word's end is not read
            alpha = np.zeros((width + 1, len(rows), prob.shape[1]))
            alpha[0] = 1.0
            for end, found in enumerate(ends, 1):
                for length, hit, ids in found:
                    alpha[end, hit] += alpha[end - length, hit] * prob[ids]
            out[rows] = np.log(alpha[last[rows], np.arange(len(rows))])
        return out

    def long_expected(self, word: str, weight: float, prob: np.ndarray) -> np.ndarray:
        """Expected piece counts of one long word, in logarithms."""
        counts, log_prob = np.zeros(self.n + 1), np.log(prob)
        steps = list(self.long_forward(word, log_prob))
        alpha = np.concatenate([[0.0], [float(now[0]) for now, _ in steps]])
        beta = np.full(len(alpha), -np.inf)
        beta[-1] = 0.0
        for end in range(len(steps), 0, -1):
            ids = steps[end - 1][1]
            lengths = np.flatnonzero(ids >= 0) + 1
            through = log_prob[ids[lengths - 1], 0] + beta[end]
            beta[end - lengths] = np.logaddexp(beta[end - lengths], through)
            counts[ids[lengths - 1]] += weight * np.exp(alpha[end - lengths] + through - alpha[-1])
        return counts

    def expected(self, words: list[str], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """Expected piece counts of one language's words under its probabilities (forward and backward)."""
        counts = np.zeros(self.n + 1)
        short = [i for i, w in enumerate(words) if len(w) <= PLAIN_CHARS]
        if len(short) < len(words):
            for i in sorted(set(range(len(words))).difference(short)):
                counts += self.long_expected(words[i], float(weight[i]), prob)
            words, weight = [words[i] for i in short], weight[short]
        p = prob[:, 0]
        for rows, width, ends in self.edges(words):
            alpha = np.zeros((width + 1, len(rows)))
            beta = np.zeros((width + 1, len(rows)))
            alpha[0] = beta[width] = 1.0
            for end, found in enumerate(ends, 1):
                for length, hit, ids in found:
                    alpha[end, hit] += alpha[end - length, hit] * p[ids]
            scale = weight[rows] / alpha[width]
            for end in range(width, 0, -1):
                for length, hit, ids in ends[end - 1]:
                    through = p[ids] * beta[end, hit]
                    beta[end - length, hit] += through
                    counts += np.bincount(ids, alpha[end - length, hit] * through * scale[hit], self.n + 1)
        return counts


class Model:
    """Piece probabilities (pieces + 1 by languages), languages in ascending order, log priors."""

    def __init__(self, pieces: list[str], langs: list[str], prob: np.ndarray, prior: np.ndarray):
        self.pieces, self.langs, self.prob, self.prior = pieces, langs, prob, prior


class Scorer:
    """Scores texts of one task; remembers the log probabilities of up to ``KNOWN_WORDS`` words."""

    def __init__(self, model: Model):
        self.model, self.table = model, Pieces(model.pieces)
        self.number: dict[str, int] = {}
        self.logs = np.empty((KNOWN_WORDS, len(model.langs)))

    def _numbers(self, words: list[str]) -> np.ndarray:
        """Row numbers of the words in ``logs``; new words are scored together, in blocks."""
        if len(self.number) + len(words) > KNOWN_WORDS:
            self.number.clear()
        new = list(set(words).difference(self.number))
        for at in range(0, len(new), 20_000):
            part, n = new[at:at + 20_000], len(self.number)
            self.logs[n:n + len(part)] = self.table.forward(part, self.model.prob)
            self.number.update(zip(part, range(n, n + len(part)), strict=True))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def __call__(self, words: list[str]) -> tuple[str, float, float, int]:
        """Language, its posterior, log probability a character and number of characters of a text's words; ('und', 0.0, 0.0, 0) without a letter or without languages."""
        if not words or not self.model.langs:
            return "und", 0.0, 0.0, 0
        total = np.zeros(len(self.model.langs))
        for at in range(0, len(words), KNOWN_WORDS // 4):
            total += self.logs[self._numbers(words[at:at + KNOWN_WORDS // 4])].sum(axis=0)
        chars = sum(map(len, words))
        likely = total + self.model.prior
        share = np.exp(likely - likely.max())
        best = int(np.argmax(likely))  # ties: the first language in order
        return self.model.langs[best], float(share[best] / share.sum()), float(total[best] / chars), chars

    def many(self, texts: list[str | None]) -> Iterator[tuple[str, float, float, int]]:
        """Scores of a batch; its new words are scored at once, as long as the batch and they can be remembered."""
        split, held, words = [], 0, set()
        for t in texts:
            if held > KNOWN_WORDS or len(words) > KNOWN_WORDS // 4:
                break
            split.append(split_words(t))
            held += len(split[-1])
            words.update(split[-1])
        if self.model.langs and len(words) <= KNOWN_WORDS // 2:
            self._numbers(list(words))
        for k, t in enumerate(texts):
            yield self(split[k] if k < len(split) else split_words(t))


def fit(docs: DataFrame, lang: Column, text: Column, key: Column, vocabulary: str) -> Model:
    """Learn from the rows of ``docs`` with a language; ``key`` picks the sample (about ``SAMPLE_DOCS`` a language) by hash."""
    pieces = vocabulary_pieces(vocabulary)
    rows = docs.select(lang.alias("lang"), text.alias("text"), key.alias("key")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model(pieces, [], np.zeros((len(pieces) + 1, 0)), np.zeros(0))
    chance = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) / 1_000_000
    rate = F.lit(0.0)
    for name in langs:
        rate = F.when(F.col("lang") == name, F.lit(min(1.0, SAMPLE_DOCS / counts[name]))).otherwise(rate)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            c = Counter((x, w) for x, t in zip(df["lang"], df["text"], strict=True) for w in split_words(t))
            yield pd.DataFrame([(x, w, n) for (x, w), n in c.items()], columns=["lang", "word", "n"])

    short_batches(docs.sparkSession)
    words = (rows.filter(chance < rate).select("lang", "text").mapInPandas(count, "lang string, word string, n long")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    words = stored(words, "lang-words")
    table = Pieces(pieces)
    columns = []
    for name in langs:
        own = words.filter(F.col("lang") == name).toPandas().sort_values(["n", "word"], ascending=[False, True])  # the words of the sample
        own_words, weight = own["word"].tolist(), own["n"].to_numpy(float)
        # start from uniform pieces, so that short cuts are not preferred beforehand
        prob = np.full((table.n + 1, 1), 1.0 / table.n)
        for _ in range(ROUNDS if own_words else 0):
            counts_of = table.expected(own_words, weight, prob)
            prob[:, 0] = (counts_of + 0.01) / (counts_of.sum() + 0.01 * (table.n + 1))
            prob[table.n] = UNKNOWN
        prob[table.n] = UNKNOWN
        columns.append(prob[:, 0])
    total = sum(counts.values())
    return Model(pieces, langs, np.stack(columns, 1), np.log([counts[x] / total for x in langs]))


def predict(docs: DataFrame, model: Model, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with one added struct column ``into``: ``lang_pred``, ``score``, ``fit`` and ``n_letters``.

    ``lang_pred`` is a learned language, or 'und' with score 0.0 for a null text and one without a letter (empty and blank
    ones among them); ``score`` is the posterior of the language, from 0 to 1, among the learned ones; ``fit`` the log probability a letter under it, over
    all ``n_letters``, which is low for other languages and for no language.  Ties go to the first language in order.  Texts are
    read whole; a row's result depends on its text alone, so repeated rows agree; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages numbers

    @F.pandas_udf("lang_pred string, score double, fit double, n_letters bigint")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame(list(scorer.many([t if isinstance(t, str) else None for t in texts])), columns=["lang_pred", "score", "fit", "n_letters"])

    short_batches(docs.sparkSession)
    return docs.withColumn(into, run(F.col(f"`{text_col}`")))


def usual_fit(found: DataFrame, lang: Column, into: str = "language") -> dict[str, tuple[float, float, float]]:
    """Per language, over all rows of ``found`` that are labelled and predicted with it: the median of their fits; how far below it a
    long text may lie, twice as far as all but a thousandth do, ``ROOM`` at least; and the usual deviation times the root of the number of letters."""
    rows = found.select(lang.alias("lang"), F.col(f"{into}.*")).filter("lang = lang_pred AND n_letters > 0")
    low = {r["lang"]: r["q"] for r in rows.groupBy("lang").agg(F.percentile_approx("fit", [0.5, 0.001], 10_000).alias("q")).collect()}
    if not low:
        return {}
    centre = F.create_map(*[F.lit(x) for name, q in low.items() for x in (name, q[0])])[F.col("lang")]
    off = F.abs(F.col("fit") - centre) * F.sqrt("n_letters")
    spread = {r["lang"]: r["s"] for r in rows.groupBy("lang").agg(F.percentile_approx(off, 0.5, 10_000).alias("s")).collect()}
    return {name: (middle, max(ROOM, 2 * (middle - least)), spread[name]) for name, (middle, least) in low.items()}


def fits(usual: dict[str, tuple[float, float, float]], into: str = "language") -> Column:
    """Whether a text lies in the range of its predicted language: texts of a language not learned, or of none, lie far below.  Short texts
    have more room."""
    out = F.lit(False)
    for name, (middle, room, spread) in usual.items():
        least = F.lit(middle - room) - SHORT * spread / F.sqrt(f"{into}.n_letters")
        out = F.when(F.col(f"{into}.lang_pred") == name, F.col(f"{into}.fit") >= least).otherwise(out)
    return out
