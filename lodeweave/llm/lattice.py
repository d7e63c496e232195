"""Language-model scores: the probability of a text over all its segmentations into subword pieces.

The vocabulary is an existing tokenizer's pieces with its scores; what is learned is how likely each piece is. Texts are
lower-cased (A-Z) and cut into words at white space; a word is a mark and its characters, and every text ends with an end
token. Pieces hold a mark only at their start, so the lattice of a text is one lattice for each word, and its probability
is the product of the words' and the end's. A word's is summed over all segmentations by forward recursion in log space;
a character that is no piece is spelled by its bytes, which are pieces too. Pieces that hold a mark elsewhere are not
used (they could not occur). Words of a batch go through the recursion together, in numpy, dealt by length; words longer
than the last of LENGTHS one by one.

Learning: each block of texts sends its words with their counts in training texts; summed by word, these give the
word counts. No unigram vocabulary is at hand (the files have merge ranks for scores, which are no probabilities), so the
ranks are read as Zipf's law, p ~ 1 / (rank + 1), and these weights are fitted once by forward-backward: each training
word's segmentations give their pieces expected counts. The piece counts are a table as large as the vocabulary, in
fixed point, so that sums do not depend on their order; a piece's probability is its count plus one over all. Each block
then gets back the figures of its own words only, so no task ever holds the corpus' words, and a word of every text
costs one row for each block.

The base score is that of single words: the sum over tokens of log10((c + 1) / (N + V + 1)).

Cases: a null text is empty and has the end token only; a null id counts as the empty text for the choice of training
texts; no training text gives counts of 0; very long words cost their length times the longest piece; rows that
repeat are scored (and learned from) each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import inf, log, log1p, exp

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import mix, powers, read_table, remainder, small_batches, stored

MODEL = "piece_bpe_32k.model"
MODULUS, HELD_OUT = 7, 2
BLOCK = 8 << 20
_MARK = "▁"
#: Words with their mark that go through the recursion together are at most so long; of whole expected counts, so many units are one.
LENGTHS, FIXED = (6, 9, 12, 16, 24, 32, 48, 64), 1 << 16
WORDS_A_TASK = 100_000
_LOG10 = log(10)
#: Not a word: words have no white space.
_END = b"\n"
_BLOCK = "block long, ids array<long>, held array<boolean>, lens array<long>, text binary"


class Pieces:
    """The pieces of a sentencepiece model that may occur in a marked word, and their first weights."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        usable = (i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)))
        self.ids = {piece: i for i in usable if _MARK not in (piece := model.id_to_piece(i))[1:]}
        self.longest = max(map(len, self.ids))
        self.end = model.get_piece_size()  # the end token's number
        self.size = self.end + 1
        rank = np.full(self.size, float(self.size))
        for i in self.ids.values():
            rank[i] = max(0.0, -model.get_score(i))
        weight = 1 / (rank + 1)
        weight[[i for i in range(self.end) if i not in set(self.ids.values()) | set(self.byte_ids.values())]] = 0
        with np.errstate(divide="ignore"):
            self.first = np.log(weight / weight.sum())
        # pieces of two characters or more by hash; a table of bits says quickly that a string is none
        several = sorted((piece for piece in self.ids if len(piece) > 1), key=len)
        value = np.array([int(_string_hashes(_code_points([x], len(x))).of(0, len(x))[0]) for x in several], np.uint64)
        order = np.argsort(value)
        self.hashes, self.numbers = value[order], np.array([self.ids[x] for x in several], np.int64)[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.hashes >> np.uint64(42)).astype(np.int64)] = True

    def known(self) -> int:
        """Pieces that can occur, the end among them."""
        return len(self.ids) + len(self.byte_ids) + 1


_loaded: dict[str, Pieces] = {}


def pieces_at(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _code_points(words: list[str], width: int) -> np.ndarray:
    """One row for each word; zeros behind its end."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


class _string_hashes:
    """Hashes of the strings between any two places, for all rows at once."""

    def __init__(self, chars: np.ndarray):
        n, width = chars.shape
        self.sums, self.inverse = np.zeros((width + 1, n), np.uint64), powers(width + 1, True)
        np.cumsum((chars.T.astype(np.uint64) + np.uint64(1)) * powers(width)[:, None], axis=0, out=self.sums[1:])

    def of(self, start: int, end: int) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + np.uint64(end - start))


def _marked(word: str) -> str:
    return _MARK + word.replace(_MARK, "\ufffd")  # a mark within a word can't be told from a space: as unknown


def _spelled(c: str, pieces: Pieces) -> list[int]:
    """A character's pieces: itself, or its bytes."""
    return [pieces.ids[c]] if c in pieces.ids else [pieces.byte_ids[b] for b in c.encode()]


def word_log_probability(word: str, pieces: Pieces, scores) -> float:
    """ln of the sum over all segmentations of the marked word of the product of the pieces' probabilities, for one word."""
    return _one(_marked(word), pieces, scores)[0][-1]


def _one(text: str, pieces: Pieces, scores) -> tuple[list[float], list[tuple[int, int, list[int], float]]]:
    """The forward sums at each place, and the arcs (from, to, pieces, ln weight) of the lattice."""
    n, longest, ids = len(text), pieces.longest, pieces.ids
    forward, arcs = [0.0] + [-inf] * n, []
    for at in range(n):
        own = [(at + 1, _spelled(text[at], pieces))]
        own += [(to, [piece]) for to in range(at + 2, min(n, at + longest) + 1) if (piece := ids.get(text[at:to])) is not None]
        for to, path in own:
            weight = sum(scores[p] for p in path)
            arcs.append((at, to, path, weight))
            forward[to] = _log_sum(forward[to], forward[at] + weight)
    return forward, arcs


def _log_sum(a: float, b: float) -> float:
    high, low = (a, b) if a > b else (b, a)
    return high if low == -inf else high + log1p(exp(low - high))


def _expected_one(text: str, times: int, pieces: Pieces, scores, total: np.ndarray) -> None:
    forward, arcs = _one(text, pieces, scores)
    backward = [-inf] * len(text) + [0.0]
    for at, to, _, weight in reversed(arcs):
        backward[at] = _log_sum(backward[at], weight + backward[to])
    for at, to, path, weight in arcs:
        for piece in path:
            total[piece] += np.rint(exp(forward[at] + weight + backward[to] - forward[-1]) * times * FIXED)


class Lattices:
    """The lattices of many words of like length, and their forward sums."""

    def __init__(self, texts: list[str], pieces: Pieces, scores: np.ndarray):
        self.lens = np.array([len(t) for t in texts])
        width, n = int(self.lens.max()), len(texts)
        chars = _code_points(texts, width)
        hashes = _string_hashes(chars)
        self.forward = np.full((width + 1, n), -inf)
        self.forward[0] = 0
        self.arcs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []  # from, to, rows, piece or -1 - character, ln weight
        self.spelling: list[list[int]] = []
        known: dict[int, int] = {}
        for at in range(width):
            rows = np.flatnonzero(self.lens > at)
            kinds, which = np.unique(chars[rows, at], return_inverse=True)
            for c in kinds.tolist():
                if c not in known:
                    known[c] = len(self.spelling)
                    self.spelling.append(_spelled(chr(c), pieces))
            number = np.array([known[c] for c in kinds.tolist()])
            weight = np.array([sum(scores[p] for p in self.spelling[k]) for k in number.tolist()])
            self._add(at, at + 1, rows, (-1 - number)[which], weight[which])
            for to in range(at + 2, min(width, at + pieces.longest) + 1):
                h = hashes.of(at, to)
                rows = np.flatnonzero(pieces.seen[(h >> np.uint64(42)).astype(np.int64)])
                if len(rows):
                    place = np.minimum(np.searchsorted(pieces.hashes, h[rows]), len(pieces.hashes) - 1)
                    real = (pieces.hashes[place] == h[rows]) & (self.lens[rows] >= to)
                    rows, piece = rows[real], pieces.numbers[place[real]]
                    if len(rows):
                        self._add(at, to, rows, piece, scores[piece])

    def _add(self, at: int, to: int, rows: np.ndarray, piece: np.ndarray, weight: np.ndarray) -> None:
        self.arcs.append((at, to, rows, piece, weight))
        self.forward[to, rows] = np.logaddexp(self.forward[to, rows], self.forward[at, rows] + weight)

    def log_probability(self) -> np.ndarray:
        return self.forward[self.lens, np.arange(len(self.lens))]

    def expected(self, times: np.ndarray, total: np.ndarray) -> None:
        """Adds each piece's expected count, in fixed point."""
        backward = np.full(self.forward.shape, -inf)
        backward[self.lens, np.arange(len(self.lens))] = 0
        own = np.zeros(len(self.spelling))
        last = self.log_probability()
        for at, to, rows, piece, weight in reversed(self.arcs):
            onward = weight + backward[to, rows]
            share = np.rint(np.exp(self.forward[at, rows] + onward - last[rows]) * times[rows] * FIXED)
            backward[at, rows] = np.logaddexp(backward[at, rows], onward)
            if to == at + 1:
                own += np.bincount(-1 - piece, share, len(own))
            else:
                total += np.bincount(piece, share, len(total))
        for path, n in zip(self.spelling, own.tolist(), strict=True):
            for piece in path:
                total[piece] += n


def _grouped(texts: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
    """(places, are they for the one by one way) of texts of like length."""
    group = np.searchsorted(LENGTHS, np.fromiter(map(len, texts), np.int64, len(texts)))
    for k in np.unique(group).tolist():
        places = np.flatnonzero(group == k)
        for at in range(0, len(places), 4096):
            yield places[at : at + 4096], k == len(LENGTHS)


def log_probabilities(words: list[str], pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """ln of each word's probability."""
    texts, out = [_marked(w) for w in words], np.zeros(len(words))
    for places, alone in _grouped(texts):
        some = [texts[i] for i in places.tolist()]
        out[places] = [_one(t, pieces, scores)[0][-1] for t in some] if alone else Lattices(some, pieces, scores).log_probability()
    return out


def expected_counts(words: list[str], times: np.ndarray, pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """Of each piece, FIXED to one, over all segmentations of words that occur `times`."""
    texts, total = [_marked(w) for w in words], np.zeros(pieces.size)
    for places, alone in _grouped(texts):
        some = [texts[i] for i in places.tolist()]
        if alone:
            for text, n in zip(some, times[places].tolist(), strict=True):
                _expected_one(text, n, pieces, scores, total)
        else:
            Lattices(some, pieces, scores).expected(times[places], total)
    return total.astype(np.int64)


def _tokens(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z, and the white space of the contract


def _blocks(docs: DataFrame) -> DataFrame:
    """Texts in blocks of about BLOCK bytes, numbered; stored, so the numbers stand."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        ids, held, texts, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            columns = [[(task << 32) + seq], [ids], [held], [[len(x) for x in texts]], [pa.compress(b"".join(texts), "zstd", asbytes=True)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "ids", "held", "lens", "text"])

        for batch in batches:
            for i, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
                ids.append(i)
                held.append(h)
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= BLOCK:
                    yield block()
                    seq, ids, held, texts, size = seq + 1, [], [], [], 0
        if ids:
            yield block()

    small_batches(docs.sparkSession)
    held = remainder("doc_id", MODULUS) == HELD_OUT
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInArrow(run, _BLOCK), "blocks", "uncompressed")


def _texts(columns, i: int) -> list[bytes]:
    lens = columns["lens"][i].as_py()
    text = pa.decompress(columns["text"][i].as_buffer(), sum(lens), "zstd", asbytes=True) if sum(lens) else b""
    ends = np.cumsum(lens).tolist()
    return [text[e - n : e] for e, n in zip(ends, lens, strict=True)]


def _words(blocks: DataFrame) -> DataFrame:
    """(word, block, i, n): each block's words, their places in its sorted list of words, and their counts in its training texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                count: Counter[bytes] = Counter()
                words = {_END}
                for text, held in zip(_texts(batch, i), batch["held"][i].as_py(), strict=True):
                    if held:
                        words.update(_tokens(text))
                    else:
                        count.update(_tokens(text))
                        count[_END] += 1
                listed = sorted(words.union(count))
                n = [count[w] for w in listed]  # a Counter gives 0 for the others
                yield pa.RecordBatch.from_arrays([pa.array(listed, pa.binary()), pa.array([batch["block"][i].as_py()] * len(n), pa.int64()), pa.array(range(len(n)), pa.int32()), pa.array(n, pa.int64())], ["word", "block", "i", "n"])

    return blocks.select("block", "held", "lens", "text").mapInArrow(run, "word binary, block long, i int, n long")


def _piece_counts(counts: DataFrame, path: str) -> np.ndarray:
    """Of each piece, expected over all segmentations of the training words under the first weights."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_at(path)
        for batch in batches:
            words, times = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            real = np.array([w != _END for w in words], bool)
            total = expected_counts([w.decode() for w in words if w != _END], times[real], pieces, pieces.first)
            total[pieces.end] += int(times[~real].sum()) * FIXED
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

    found = counts.filter("c > 0").select("word", "c").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))
    total = np.zeros(pieces_at(path).size)
    for piece, n in found.collect():  # as many rows as the vocabulary has pieces at most
        total[piece] = int(n) / FIXED
    return total


def lattice_scores(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row; path: the model on the executors."""
    spark = docs.sparkSession
    blocks = _blocks(docs)
    words = stored(_words(blocks), "words")
    counts = stored(words.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    n, v, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count("*")).first()
    # dealt by their number, as the recursion's cost is in the words, not in their bytes
    dealt = counts.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-distinct // WORDS_A_TASK)))
    by_piece = _piece_counts(dealt, path)
    sent = spark.sparkContext.broadcast(np.log((by_piece + 1) / (by_piece.sum() + pieces_at(path).known())))

    def score_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, scores = pieces_at(path), sent.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            got = log_probabilities(["" if w == _END else w.decode() for w in words], pieces, scores)
            got[[w == _END for w in words]] = scores[pieces.end]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got / _LOG10)], ["word", "c", "score"])

    scored = dealt.mapInArrow(score_words, "word binary, c long, score double")
    asked = words.select("word", "block", "i").join(scored, "word").select("block", "i", "c", "score")  # words stay where they are
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), blocks.count())  # a block a task, however many there are

    def score_texts(block: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        if not len(block):
            return pa.table([pa.array([], k) for k in kinds], names=names)
        texts = [_tokens(text) for text in _texts(block, 0)]
        place = {w: i for i, w in enumerate(sorted({_END}.union(*texts)))}
        answers = answers.sort_by("i")
        c = answers["c"].to_numpy().astype(np.float64)
        base = np.log10((c + 1) / (n + v + 1))
        score = answers["score"].to_numpy()
        out: list[list] = [[], [], [], []]
        for words_of in texts:
            at = np.fromiter(map(place.__getitem__, [*words_of, _END]), np.int64)
            for column, x in zip(out, (len(at), int((c[at] > 0).sum()), float(base[at].sum()), float(score[at].sum())), strict=True):
                column.append(x)
        size = len(out[0])
        columns = [block["ids"][0].as_py(), block["held"][0].as_py(), out[0], out[1], [n] * size, out[2], out[3]]
        return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=names)

    return blocks.repartition(tasks, "block").groupBy("block").cogroup(asked.repartition(tasks, "block").groupBy("block")).applyInArrow(score_texts, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op5_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lattice_scores(read_table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
