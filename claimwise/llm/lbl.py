"""Log-bilinear language model, trained by noise-contrastive estimation in numpy.

Tokens: words (runs without ASCII white space, A-Z lower-cased) and one end per text.  The model predicts a class from the two
before it: the ``HEAD`` most frequent words, as far as they occur ``LEAST`` times, and always the first ``WORDS`` are classes of their own; every other word
belongs to a suffix class by its last bytes (so these classes hold what a new text shows of words not seen before); the number of suffix classes rises with the root of the number of distinct words.  Classes stand in groups of about equal
frequency, as many as the root of their number.  A class has the probability of its group in the context times its own inside
the group, each a softmax over products of vectors with the context's (each place's vector weighted by the place), plus a bias; both
sums are computed in full, so probabilities are normalised.  Inside a suffix class a word has the
probability (count + 1) over the class's tokens, words and one for the unseen.

Every text is split and coded once, into a table of class numbers from which rounds and scores are computed.  Training covers all training texts.  They are dealt by a hash of id and text into parts of about ``PART`` tokens and, inside a part, into
``ROUNDS`` rounds.  In a round every part runs stochastic gradient descent over its texts of that round, from the average that all
parts reached in the round before; so the steps depend on the texts alone, not on the files, partitions or cores they come from.  Noise
groups are shared in a batch, so that the work is matrix products, and noise words are drawn inside each token's group.  A row of parameters is
averaged by tokens over the parts that changed it.  Counts of all words are a
table; the counts of the ``COUNTED`` most frequent words are held by the workers, the rare words of each text meet the table in a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwise.llm.common import short_batches, stored

#: Least numbers of own words (the end among them) and of suffix classes, most words with vectors of their own, and most words whose counts workers hold.
WORDS, SUFFIXES, HEAD, COUNTED = 800, 64, 50_000, 250_000
#: Occurrences from which a word's own vectors can be learned.
LEAST = 5
SIZE, PLACES = 16, 2
#: Noise groups of a batch, noise words of a token inside its group.
NOISE, INSIDE, BATCH, RATE = 32, 2, 4096, 0.15
#: Tokens of a part and rounds of training.  A part trains on a ``ROUNDS``-th of its tokens in each round.
PART, ROUNDS = 1 << 23, 4
#: Tokens that are scored at once.
SCORED = 1 << 19
#: Slabs of the matrix of parameters, each summed by one task.
SLABS = 32
#: Columns of the matrix of parameters.
COLUMNS = SIZE + 3
#: Distinct words that a counting task holds before it passes its counts on.
HELD = 600_000
#: The end token; no word is empty.
END = ""


def suffix_class(word: bytes, own: int = WORDS, suffixes: int = SUFFIXES) -> int:
    """Class number of a word without a class of its own: after the ``own`` ones, by its last three bytes."""
    return own + xxhash.xxh32_intdigest(word[-3:]) % suffixes


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Tokens of all texts, the empty end of each among them, and where the texts start in them (and the last one ends)."""
    texts = pc.ascii_ltrim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    texts = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(texts, "", " "))  # after the last blank stands the end
    lists = pc.ascii_split_whitespace(texts)
    return lists.offsets.to_numpy(), lists.values


def token_counts(docs: DataFrame, text_col: str) -> DataFrame:
    """(word, c): occurrences of each token in all texts, ends included as ``END``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed(held: list[pa.RecordBatch]) -> pa.Table:
            return pa.Table.from_batches(held).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])

        held, rows = [], 0
        for batch in batches:
            held.append(pa.RecordBatch.from_arrays(pc.value_counts(tokens_of(batch.column(0))[1]).flatten(), ["word", "c"]))
            rows += held[-1].num_rows
            if rows > HELD:
                found = summed(held)
                held, rows = found.to_batches(), found.num_rows
                if rows > HELD // 2:
                    yield from held
                    held, rows = [], 0
        if held:
            yield from summed(held).to_batches()

    return docs.select(F.col(text_col)).mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """Codes of tokens: those held by rank (the first ``own`` are classes), others after them by suffix class.

    ``class_tokens``, ``class_words``: tokens and distinct words of each suffix class."""

    def __init__(self, words: list[str], counts: list[int], total: int, distinct: int, class_tokens: np.ndarray, class_words: np.ndarray, own: int = WORDS):
        self.words, self.counts, self.total, self.distinct = words, np.array(counts, np.float64), total, distinct
        self.own, self.suffixes, self.held = own, len(class_tokens), len(words)
        classes = own + self.suffixes
        mine = min(own, self.held)
        self.class_of = np.empty(self.held + self.suffixes, np.int64)
        self.class_of[:mine] = np.arange(mine)
        self.class_of[mine:self.held] = [suffix_class(w.encode(), own, self.suffixes) for w in words[mine:]]
        self.class_of[self.held:] = own + np.arange(self.suffixes)
        self.inside = np.log10(class_tokens + class_words + 1.0)  # log10 of what words of a suffix class are divided by
        c = np.zeros(self.held + self.suffixes)
        c[:self.held] = self.counts
        self.base = np.log10(c + 1) - np.log10(total + distinct + 1.0)
        self.within = np.zeros(len(c))
        self.within[mine:] = np.log10(c[mine:] + 1) - self.inside[self.class_of[mine:] - own]  # a rare word's own count is added by the join
        unigram = np.zeros(classes)
        unigram[:mine] = self.counts[:mine]
        unigram[own:] = class_tokens
        self.unigram = (unigram + 1) / (unigram.sum() + classes)
        # neighbours in a group of about equal frequency to the others
        n = int(np.ceil(np.sqrt(classes)))
        middle = np.cumsum(self.unigram) - self.unigram / 2
        self.group_of = np.unique((middle * n).astype(np.int64).clip(0, n - 1), return_inverse=True)[1]
        self.first = np.searchsorted(self.group_of, np.arange(self.group_of[-1] + 2))  # where groups start, and the end
        self.mass = np.add.reduceat(self.unigram, self.first[:-1])

    def lookup(self) -> Lookup:
        return Lookup({w.encode(): i for i, w in enumerate(self.words)}, self.suffixes)


class Suffixes(dict):
    """Last bytes of a word -> code of its suffix class."""

    def __init__(self, held: int, suffixes: int):
        super().__init__()
        self.held, self.suffixes = held, suffixes

    def __missing__(self, end: bytes) -> int:
        code = self[end] = suffix_class(end, self.held, self.suffixes)
        return code


class Lookup:
    """Codes of tokens: those held by their rank, the others by their last three bytes."""

    def __init__(self, head: dict[bytes, int], suffixes: int):
        self.head, self.ends = head, Suffixes(len(head), suffixes)

    def __getitem__(self, word: bytes) -> int:
        code = self.head.get(word)
        return self.ends[word[-3:]] if code is None else code

    def of(self, words: list[bytes]) -> np.ndarray:
        """Codes of many tokens."""
        codes = np.fromiter(map(self.head.get, words, repeat(-1)), np.int64, len(words))
        at = np.flatnonzero(codes < 0)
        codes[at] = np.fromiter(map(self.ends.__getitem__, [words[i][-3:] for i in at.tolist()]), np.int64, len(at))
        return codes


def read_vocabulary(counts: DataFrame) -> Vocabulary:
    """The vocabulary from the table of counts: ``COUNTED`` rows and one per suffix class come to the driver."""
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    suffixes = SUFFIXES
    while suffixes ** 2 < sums["v"]:
        suffixes *= 2
    # the least count of the words held, from a histogram of bounded size: exact for small counts, 1 % wide above
    octave = F.floor(F.log2("c"))
    coarse = F.when(F.col("c") < 4096, F.col("c")).otherwise((F.floor(F.col("c") / F.pow(F.lit(2.0), octave - 6)) * F.pow(F.lit(2.0), octave - 6)).cast("long"))
    least, above = None, 0  # None: more words than the head holds share the largest count
    for r in sorted(counts.groupBy(coarse.alias("c")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r["c"]):
        above += r["n"]
        if above > COUNTED:
            break
        least = r["c"]
    rows = [] if least is None else counts.filter(F.col("c") >= least).collect()
    head = sorted(rows, key=lambda r: (-r["c"], r["word"]))

    @F.pandas_udf("int")
    def kind(words: pd.Series) -> pd.Series:
        return pd.Series([suffix_class(w.encode(), 0, suffixes) for w in words], dtype=np.int32)

    tokens, words = np.zeros(suffixes), np.zeros(suffixes)
    for r in counts.groupBy(kind("word").alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        tokens[r["k"]], words[r["k"]] = r["n"], r["v"]
    own = min(HEAD, max(sum(r["c"] >= LEAST for r in head), min(WORDS, len(head))))
    for r in head[:own]:  # classes of their own
        k = suffix_class(r["word"].encode(), 0, suffixes)
        tokens[k] -= r["c"]
        words[k] -= 1
    return Vocabulary([r["word"] for r in head], [r["c"] for r in head], int(sums["n"]), int(sums["v"]), tokens, words, own)


class Parameters:
    """Context vectors, class vectors, place weights, group vectors and biases, each a row of one matrix.

    Columns: the vector, the bias, and the sums of squared gradients of both, which set the rates."""

    def __init__(self, vocabulary: Vocabulary):
        n, groups = len(vocabulary.unigram), len(vocabulary.mass)
        self.n, self.groups = n, groups
        self.context = np.random.default_rng(3).normal(0, 0.3, (n, SIZE)).astype(np.float32)
        self.target, self.group = np.zeros((n, SIZE), np.float32), np.zeros((groups, SIZE), np.float32)
        self.place = np.ones((PLACES, SIZE), np.float32)
        self.bias = np.log(vocabulary.unigram / vocabulary.mass[vocabulary.group_of]).astype(np.float32)
        self.group_bias = np.log(vocabulary.mass).astype(np.float32)
        self.seen = np.full((2 * n + PLACES + groups, 2), 1e-2, np.float32)

    def _parts(self) -> tuple[slice, slice, slice, slice]:
        n = self.n
        return slice(0, n), slice(n, 2 * n), slice(2 * n, 2 * n + PLACES), slice(2 * n + PLACES, None)

    def rows(self) -> np.ndarray:
        m = np.zeros((len(self.seen), COLUMNS), np.float32)
        context, target, place, group = self._parts()
        m[context, :SIZE], m[target, :SIZE], m[place, :SIZE], m[group, :SIZE] = self.context, self.target, self.place, self.group
        m[target, SIZE], m[group, SIZE] = self.bias, self.group_bias
        m[:, SIZE + 1:] = self.seen
        return m

    def load(self, m: np.ndarray) -> None:
        m = m.astype(np.float32)
        self.context, self.target, self.place, self.group = (m[part, :SIZE].copy() for part in self._parts())
        _, target, _, group = self._parts()
        self.bias, self.group_bias, self.seen = m[target, SIZE].copy(), m[group, SIZE].copy(), m[:, SIZE + 1:].copy()

    def before(self, contexts: np.ndarray) -> list[np.ndarray]:
        """The vectors of the classes in each place."""
        return [self.context.take(contexts[:, i], axis=0) for i in range(PLACES)]

    def hidden(self, before: list[np.ndarray]) -> np.ndarray:
        return sum(x * self.place[i] for i, x in enumerate(before))


class Segments:
    """Equal rows brought together, to sum what belongs to each."""

    def __init__(self, rows: np.ndarray):
        order = np.argsort(rows.astype(np.uint16) if rows.max() < 1 << 16 else rows, kind="stable")  # short numbers have a faster sort
        found = rows[order]
        first = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        sizes = np.diff(first, append=len(rows))
        self.rows, self.one = found[first], order[first]
        self.many = np.flatnonzero(sizes > 1)  # most rows stand alone and need no sum
        self.lines = order[np.repeat(sizes > 1, sizes)]
        self.starts = np.cumsum(sizes[self.many]) - sizes[self.many]

    def sums(self, grad: np.ndarray) -> np.ndarray:
        """Sums of the lines of ``grad`` by row."""
        return self._sums(lambda lines: grad.take(lines, axis=0))

    def weighted(self, x: np.ndarray, of_line: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Sums by row of lines that are a row of ``x`` each, times a weight."""

        def products(lines: np.ndarray) -> np.ndarray:
            out = x.take(of_line.take(lines), axis=0)
            out *= weights.take(lines)[:, None]
            return out

        return self._sums(products)

    def _sums(self, grad: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        out = grad(self.one)
        if len(self.many):
            out[self.many] = np.add.reduceat(grad(self.lines), self.starts, axis=0)
        return out


def real_share(z: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(z)); ``z`` is overwritten."""
    with np.errstate(over="ignore"):
        np.exp(z, out=z)
    z += 1
    return np.reciprocal(z, out=z)


class Trainer:
    """Noise-contrastive estimation of groups and of classes inside groups, with a rate for each row (AdaGrad)."""

    def __init__(self, p: Parameters, vocabulary: Vocabulary, seed: int | tuple[int, ...]):
        self.p, self.v, self.rng = p, vocabulary, np.random.default_rng(seed)
        v = vocabulary
        self.group_noise = np.cumsum(v.mass)
        self.log_group = np.log(NOISE * v.mass).astype(np.float32)
        self.log_inside = np.log(INSIDE / np.diff(v.first)).astype(np.float32)  # noise words of a group are drawn evenly
        self.seen = [p.seen[part] for part in p._parts()]

    def _apply(self, x: np.ndarray, seen: np.ndarray, rows: np.ndarray, grad: np.ndarray, n: int) -> None:
        grad = grad * np.float32(n ** 0.5)
        s = seen[rows] + (grad * grad if grad.ndim == 1 else np.einsum("ij,ij->i", grad, grad) / SIZE)
        seen[rows] = s
        rate = np.float32(RATE) / np.sqrt(s)
        grad *= rate if grad.ndim == 1 else rate[:, None]
        x[rows] = x.take(rows, axis=0) + grad

    def step(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        p, v, n = self.p, self.v, len(targets)
        before = p.before(contexts)
        hidden = p.hidden(before)
        groups = v.group_of[targets]

        # the group, against groups shared by the batch
        drawn = np.minimum(np.searchsorted(self.group_noise, self.rng.random(NOISE)), p.groups - 1)
        wanted = p.group[groups]
        real = np.einsum("ij,ij->i", hidden, wanted) + p.group_bias[groups] - self.log_group[groups]
        false = hidden @ p.group[drawn].T + (p.group_bias[drawn] - self.log_group[drawn])
        up = real_share(real) / np.float32(n)                                   # 1 - probability that the token is real
        down = real_share(np.negative(false, out=false)) / np.float32(-n)      # - probability that the noise is real
        back = up[:, None] * wanted + down @ p.group[drawn]
        by_group = Segments(np.concatenate((groups, drawn)))
        group = by_group.sums(np.concatenate((hidden * up[:, None], down.T @ hidden)))
        group_bias = by_group.sums(np.concatenate((up, down.sum(axis=0))))

        # the class inside the group, against classes of the same group; a group of one has nothing to tell
        many = np.flatnonzero(v.first[groups + 1] - v.first[groups] > 1)
        if len(many):
            own, held, inside = targets[many], hidden[many], groups[many]
            low, sizes = v.first[inside], v.first[inside + 1] - v.first[inside]
            at = low[:, None] + (sizes[:, None] * self.rng.random((len(many), INSIDE), np.float32)).astype(np.int64)
            at = np.minimum(at, (low + sizes - 1)[:, None])
            noise = self.log_inside[inside]
            wanted, other = p.target.take(own, axis=0), p.target.take(at, axis=0)
            real = np.einsum("ij,ij->i", held, wanted) + p.bias[own] - noise
            false = np.einsum("ij,ikj->ik", held, other) + p.bias[at] - noise[:, None]
            up = real_share(real) / np.float32(n)
            down = real_share(np.negative(false, out=false)) / np.float32(-n)
            back[many] += up[:, None] * wanted + np.einsum("ik,ikj->ij", down, other)
            lines = np.concatenate((own, at.ravel()))
            weights = np.concatenate((up, down.ravel()))
            by_class = Segments(lines)
            of_line = np.arange(len(many))
            target = by_class.weighted(held, np.concatenate((of_line, np.repeat(of_line, INSIDE))), weights)
            bias = by_class.sums(weights)

        place = np.stack([np.einsum("ij,ij->j", back, x) for x in before])
        by_context = Segments(contexts.T.ravel())
        grad = np.empty((PLACES, n, SIZE), np.float32)
        for i in range(PLACES):
            np.multiply(back, p.place[i], out=grad[i])
        context = by_context.sums(grad.reshape(-1, SIZE))
        seen = self.seen
        self._apply(p.context, seen[0][:, 0], by_context.rows, context, n)
        if len(many):
            self._apply(p.target, seen[1][:, 0], by_class.rows, target, n)
            self._apply(p.bias, seen[1][:, 1], by_class.rows, bias, n)
        self._apply(p.place, seen[2][:, 0], np.arange(PLACES), place, n)
        self._apply(p.group, seen[3][:, 0], by_group.rows, group, n)
        self._apply(p.group_bias, seen[3][:, 1], by_group.rows, group_bias, n)


def contexts_of(classes: np.ndarray, ends: np.ndarray, end_class: int) -> np.ndarray:
    """The ``PLACES`` classes before each token; before a text's first ones stand ends.  ``ends``: where texts end in ``classes``."""
    out = np.full((len(classes), PLACES), end_class, np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    since = np.arange(len(classes)) - np.repeat(starts, ends - starts)
    for i in range(PLACES):
        ok = np.flatnonzero(since > i)
        out[ok, i] = classes[ok - i - 1]
    return out


def class_kind(vocabulary: Vocabulary) -> str:
    """Type of the class numbers in stored texts."""
    return "<u2" if len(vocabulary.unigram) <= 1 << 16 else "<i4"


def coded(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rows`` (doc_id, held_out, text) as class numbers, each text split once for training and scoring.

    Beside ``classes``: ``h`` (hash of id and text), ``n_tokens`` and, without the words that workers do not hold, ``n_known``, ``base`` and ``within`` (sums
    over the tokens); those words, with their repeats, in ``rare``."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)  # COUNTED words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        lookup, kind = v.lookup(), class_kind(v)
        for batch in batches:
            if not batch.num_rows:
                continue
            bounds, words = tokens_of(batch.column(3))
            starts, ends = bounds[:-1], bounds[1:]
            found = words.dictionary_encode()
            of_word = found.indices.to_numpy()
            codes = lookup.of(found.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist())[of_word]
            at = np.flatnonzero(codes >= v.held)
            classes = v.class_of[codes].astype(kind)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(at, bounds), pa.int32()), found.dictionary.take(pa.array(of_word[at])))
            sums = [np.add.reduceat(x, starts) for x in ((codes < v.held).astype(np.int64), v.base[codes], v.within[codes])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array((ends - starts).astype(np.int64)), *map(pa.array, sums), lists,
                 pa.array([classes[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], pa.binary())],
                ["doc_id", "held_out", "h", "n_tokens", "n_known", "base", "within", "rare", "classes"])

    rows = rows.select("doc_id", "held_out", F.xxhash64("doc_id", "text").alias("h"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, h long, n_tokens long, n_known long, base double, within double, "
                                "rare array<string>, classes binary")


def train(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Parameters after ``ROUNDS`` rounds over all ``texts`` (h, classes); a bounded number of rows comes back from each."""
    spark = texts.sparkSession
    m = Parameters(vocabulary).rows()
    if not vocabulary.total:
        return m
    parts = -(-vocabulary.total // PART)
    shared = spark.sparkContext.broadcast(vocabulary)  # COUNTED words
    dealt = texts.select(F.pmod("h", F.lit(parts)).cast("int").alias("part"), F.pmod(F.shiftrightunsigned("h", 40), F.lit(ROUNDS)).alias("round"), "h", "classes")

    for turn in range(ROUNDS):
        start = spark.sparkContext.broadcast(m)

        def trained(batches: Iterator[pa.RecordBatch], turn: int = turn, start=start) -> Iterator[pa.RecordBatch]:
            v, begun = shared.value, start.value
            kind, end = class_kind(v), int(v.class_of[v.lookup()[b""]])

            def changed(part: int, texts: list[np.ndarray]) -> pa.RecordBatch:
                p = Parameters(v)
                p.load(begun)
                trainer = Trainer(p, v, (5, turn, part))
                classes, ends = np.concatenate(texts), np.cumsum([len(t) for t in texts])
                contexts = contexts_of(classes, ends, end)
                order = trainer.rng.permutation(len(classes))
                for at in range(0, len(order), BATCH):
                    now = order[at:at + BATCH]
                    trainer.step(contexts[now], classes[now].astype(np.int64))
                now = p.rows()
                rows = np.flatnonzero((now[:, SIZE + 1:] != begun[:, SIZE + 1:]).any(axis=1))
                slabs = [rows[rows % SLABS == i] for i in range(SLABS)]
                return pa.RecordBatch.from_arrays(
                    [pa.array(range(SLABS), pa.int32()), pa.array([part] * SLABS, pa.int64()), pa.array([float(len(classes))] * SLABS, pa.float64()),
                     pa.array([x.astype(np.int32).tobytes() for x in slabs], pa.binary()), pa.array([(now[x] - begun[x]).tobytes() for x in slabs], pa.binary())],
                    ["slab", "part", "tokens", "places", "moved"])

            here, held = None, []
            for batch in batches:  # a part's rows stand together
                for part, classes in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if part != here and held:
                        yield changed(here, held)
                        held = []
                    here = part
                    held.append(np.frombuffer(classes.as_py(), kind))
            if held:
                yield changed(here, held)

        def averaged(batches: Iterator[pa.RecordBatch], high: int = len(m)) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for batch in batches:
                for slab, tokens, places, moved in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    if slab not in sums:
                        size = len(range(slab, high, SLABS))
                        sums[slab] = np.zeros((size, COLUMNS)), np.zeros(size)
                    at = np.frombuffer(places, np.int32) // SLABS
                    sums[slab][0][at] += tokens * np.frombuffer(moved, np.float32).reshape(-1, COLUMNS)
                    sums[slab][1][at] += tokens
            for slab, (total, weight) in sums.items():
                mean = total / np.maximum(weight, 1)[:, None]
                yield pa.RecordBatch.from_arrays([pa.array([slab], pa.int32()), pa.array([mean.astype(np.float32).tobytes()], pa.binary())], ["slab", "mean"])

        now = dealt.filter(F.col("round") == turn).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "h").select("part", "classes")
        moved = now.mapInArrow(trained, "slab int, part long, tokens double, places binary, moved binary")
        few = min(SLABS, parts)
        moved = moved.repartitionById(few, F.col("slab") % few).sortWithinPartitions("slab", "part").drop("part")
        for r in moved.mapInArrow(averaged, "slab int, mean binary").collect():
            mean = np.frombuffer(bytes(r["mean"]), np.float32).reshape(-1, COLUMNS)
            m[r["slab"]::SLABS] += mean
    return m


def log_sums(z: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """log of the rows' sums of exp of ``z`` = ``left`` @ ``right``; ``z`` is overwritten.

    Rows whose plain sum overflows or nearly vanishes are computed once more below their maximum."""
    ones = np.ones(z.shape[1], np.float32)
    with np.errstate(over="ignore", divide="ignore"):
        sums = np.exp(z, out=z) @ ones
        out = np.log(sums)
    bad = np.flatnonzero(~((sums > 1e-30) & (sums < 1e38)))
    if len(bad):
        z = left[bad] @ right
        top = z.max(axis=1)
        z -= top[:, None]
        out[bad] = top + np.log(np.exp(z, out=z) @ ones)
    return out


class Scorer:
    """Normalised log10 probabilities; the groups' sum of a context is computed once per call, that inside a group once per token.

    Biases are products too: of a further column of ones of the contexts' vectors."""

    def __init__(self, vocabulary: Vocabulary, matrix: np.ndarray):
        self.v, self.p = vocabulary, Parameters(vocabulary)
        self.p.load(matrix)
        p, v = self.p, vocabulary
        self.group = np.vstack((p.group.T, p.group_bias)).astype(np.float32)
        self.inside = [np.vstack((p.target[a:b].T, p.bias[a:b])).astype(np.float32) for a, b in zip(v.first, v.first[1:])]
        self.shares = [self.factors(i) for i in range(PLACES)]
        self.products = np.empty(60_000, np.float32)  # used again by every block, so that its pages are not asked for anew

    def factors(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """What each class in a place gives to each group's exp of product, as a share of the largest, and the log of that."""
        p = self.p
        tops, shares = np.empty(p.n, np.float32), np.empty((p.n, p.groups), np.float32)
        for at in range(0, p.n, 512):
            part = slice(at, at + 512)
            z = np.matmul(p.context[part] * p.place[place], p.group.T, out=shares[part])
            if not place:
                z += p.group_bias
            tops[part] = z.max(axis=1)
            z -= tops[part, None]
            np.exp(z, out=z)
        return tops, shares

    def group_sums(self, contexts: np.ndarray, held: np.ndarray) -> np.ndarray:
        """log of the contexts' sums over groups: exp of a sum over places is a product, so exponentials are taken by class, not by context.

        Sums that nearly vanish (places that favour other groups) are computed once more from ``held``, the contexts' vectors."""
        ones = np.ones(self.p.groups, np.float32)
        tops, shares = self.shares[0]
        out, product = tops[contexts[:, 0]], shares.take(contexts[:, 0], axis=0)
        for i, (tops, shares) in enumerate(self.shares[1:], 1):
            out += tops[contexts[:, i]]
            product *= shares.take(contexts[:, i], axis=0)
        sums = product @ ones
        with np.errstate(divide="ignore"):
            out += np.log(sums)
        bad = np.flatnonzero(~(sums > 1e-30))
        if len(bad):
            out[bad] = log_sums(held[bad] @ self.group, held[bad], self.group)
        return out

    def __call__(self, contexts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        p, v = self.p, self.v
        key = contexts[:, 0]
        for i in range(1, PLACES):
            key = key * p.n + contexts[:, i]
        order = np.argsort(key)
        key = key[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = contexts[order[new]]
        # tokens by group and, inside a group, by context: equal pairs stand together
        groups = v.group_of[classes[order]]
        by_group = np.argsort(groups.astype(np.uint16) if p.groups < 1 << 16 else groups, kind="stable")
        groups, back, order = groups[by_group], (np.cumsum(new) - 1)[by_group], order[by_group]
        classes = classes[order]
        distinct, sums = np.ones((len(first), SIZE + 1), np.float32), np.empty(len(first), np.float32)
        for at in range(0, len(first), 512):  # blocks that stay in the cache
            part = slice(at, at + 512)
            distinct[part, :SIZE] = p.hidden(p.before(first[part]))
            sums[part] = self.group_sums(first[part], distinct[part])
        logs = np.empty(len(classes))
        for at in range(0, len(classes), 4096):
            part = slice(at, at + 4096)
            hidden = distinct.take(back[part], axis=0)[:, :SIZE]
            logs[part] = np.einsum("ij,ij->i", hidden, p.group.take(groups[part], axis=0)) + p.group_bias[groups[part]] - sums[back[part]]
        new[1:] = (back[1:] != back[:-1]) | (groups[1:] != groups[:-1])
        pair, starts = np.cumsum(new) - 1, np.append(np.flatnonzero(new), len(new))  # pairs of tokens, first tokens of pairs
        bounds = np.searchsorted(groups[starts[:-1]], np.arange(p.groups + 1))
        for g in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(v.first) > 1)):
            low, size = v.first[g], v.first[g + 1] - v.first[g]
            block = max(1, len(self.products) // size)
            for at in range(bounds[g], bounds[g + 1], block):
                end = min(at + block, bounds[g + 1])
                part = slice(starts[at], starts[end])
                held, line = distinct.take(back[starts[at:end]], axis=0), pair[part] - at
                z = self.products[:(end - at) * size].reshape(-1, size) if size <= len(self.products) else None
                z = np.matmul(held, self.inside[g], out=z)
                own = z.ravel().take(line * size + (classes[part] - low))
                logs[part] += own - log_sums(z, held, self.inside[g])[line]
        out = np.empty(len(classes))
        out[order] = logs
        return out / np.log(10)


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all texts by a model learned from the rows where ``training`` holds.

    Per row: ``doc_id``, ``held_out`` (not ``training``), ``n_tokens``, ``n_known`` (tokens seen in training), ``train_tokens`` (all training tokens),
    ``base_score`` (log10 of the unigram probability with add-one smoothing, summed over tokens) and ``score`` (the model's log10 probability of the text).

    A null text counts as empty: it has its end only.  Texts are read whole; a word of any length is one token.  Ties between equally
    frequent words are broken by code point.  Repeated rows count as often as they stand there and get equal results; an empty table
    gives an empty result, one without training rows gives base scores of 0."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (~F.coalesce(training, F.lit(False))).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    learned = rows.filter(~F.col("held_out"))
    counts = stored(token_counts(learned, "text"), "lbl-counts")
    vocabulary = read_vocabulary(counts)
    texts = stored(coded(rows, vocabulary).withColumn("row", F.monotonically_increasing_id()), "lbl-coded")
    matrix = train(texts.filter(~F.col("held_out")).select("h", "classes"), vocabulary)
    shared = spark.sparkContext.broadcast((vocabulary, matrix))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, m = shared.value
        scorer, kind = Scorer(v, m), class_kind(v)
        end = int(v.class_of[v.lookup()[b""]])

        def scored(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ends = np.cumsum(table["n_tokens"].to_numpy())
            classes = np.frombuffer(b"".join(table["classes"].to_pylist()), kind).astype(np.int64)
            logs = scorer(contexts_of(classes, ends, end), classes)
            return pa.RecordBatch.from_arrays(
                [table["row"].combine_chunks(), pa.array(np.add.reduceat(logs, np.concatenate(([0], ends[:-1]))))], ["row", "logs"])

        held, tokens = [], 0
        for batch in batches:  # many texts at once: contexts that repeat are computed once
            if batch.num_rows:
                held.append(batch)
                tokens += int(np.sum(batch.column(1).to_numpy()))
            if tokens >= SCORED:
                yield scored(held)
                held, tokens = [], 0
        if held:
            yield scored(held)

    logs = texts.select("row", "n_tokens", "classes").mapInArrow(run, "row long, logs double")
    found = texts.select("row", F.explode("rare").alias("word")).join(counts, "word")  # a word that was not counted adds nothing
    sums = found.groupBy("row").agg(F.count("*").alias("known_2"), F.sum(F.log10(F.col("c") + 1)).alias("own"))
    own = F.coalesce("own", F.lit(0.0))
    return texts.drop("rare", "classes").join(logs, "row").join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known_2", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.total).cast("long").alias("train_tokens"), (F.col("base") + own).alias("base_score"), (F.col("logs") + F.col("within") + own).alias("score"))
