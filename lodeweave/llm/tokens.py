"""Token counts by byte-pair merging with a heap and a linked list.

The vocabulary is that of a sentencepiece BPE model. A text's symbols start as its characters; the adjacent pair
of the lowest rank is merged again and again; the count is symbols minus merges, plus what falls back to bytes.
No identifiers are made.

A text is first cut where no merge can reach across: before a space mark that follows another character (no piece
holds one after its first other character) and around characters that no piece holds. Equal segments are counted
once and remembered, up to a bound. A new segment is cut again between characters that are neighbours in no piece. All of this is read off the vocabulary, and `BytePairs` refuses a model for
which it does not hold.

Cases: a null or empty text has 0 tokens; very long words cost n log n; rows that repeat are counted each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeweave.llm.common import read_table, small_batches

MODEL = "piece_bpe_32k.model"
OVER = 4096
#: Segments remembered by a worker, and the longest that is remembered.
REMEMBERED, LONGEST = 300_000, 64
_MARK = "▁"


class BytePairs:
    """Counts tokens as the sentencepiece model at `path` would encode, without special tokens."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        normal = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        pieces = {model.id_to_piece(i): model.get_score(i) for i in normal}
        ranks = {score: rank for rank, score in enumerate(sorted(set(pieces.values()), reverse=True))}
        self.ranks = {piece: ranks[score] for piece, score in pieces.items()}
        if any(_MARK in piece.lstrip(_MARK) for piece in pieces) or not any(model.is_byte(i) for i in ids):
            raise ValueError("the model's pieces join words, or it has no bytes to fall back to")
        if model.normalize("a  béﬁ ") != _MARK + f"a{_MARK}{_MARK}béﬁ{_MARK}":
            raise ValueError("the model changes texts in other ways than by marking spaces")
        known = {c for piece in pieces for c in piece}
        if "\n" in known:
            raise ValueError("the model's pieces join lines")
        self.segments = re.compile(f"{_MARK}*[^{_MARK}\n]+|{_MARK}+").findall
        self.singles = {piece for piece in pieces if len(piece) == 1}
        self.joins = {piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1)}
        self.remembered: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merged(self, segment: str) -> int:
        """Tokens of one segment."""
        rank_of, symbols = self.ranks.get, list(segment)
        n = count = len(symbols)
        # rank of the pair that starts at a symbol, or -1; a heap entry is rank and place in one number, and stale if they differ
        pair = [*(rank_of(a + b, -1) for a, b in zip(symbols, symbols[1:], strict=False)), -1]
        heap = [rank << 32 | i for i, rank in enumerate(pair) if rank >= 0]
        if heap:
            heapq.heapify(heap)
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            while heap:
                entry = heappop(heap)
                left = entry & 0xFFFFFFFF
                if pair[left] != entry >> 32:
                    continue
                right = after[left]
                symbols[left] = both = symbols[left] + symbols[right]
                symbols[right], pair[right] = "", -1
                count -= 1
                after[left] = nxt = after[right]
                if nxt < n:
                    before[nxt] = left
                    pair[left] = rank = rank_of(both + symbols[nxt], -1)
                    if rank >= 0:
                        heappush(heap, rank << 32 | left)
                else:
                    pair[left] = -1
                if (prv := before[left]) >= 0:
                    pair[prv] = rank = rank_of(symbols[prv] + both, -1)
                    if rank >= 0:
                        heappush(heap, rank << 32 | prv)
        if not self.singles.issuperset(segment):
            count += sum(len(s.encode()) - 1 for s in symbols if s and s not in self.ranks)
        return count

    def parted(self, segment: str) -> int:
        """Tokens of one segment, cut between characters that stand side by side in no piece: no merge reaches across."""
        joins, at, total = self.joins, 0, 0
        for i in range(1, len(segment)):
            if segment[i - 1 : i + 1] not in joins:
                total += self.remember(segment[at:i])
                at = i
        return total + (self.remember(segment[at:]) if at else self.merged(segment))

    def remember(self, part: str) -> int:
        n = self.remembered.get(part) or self.older.get(part)
        if n is None:
            n = self.merged(part)
            if len(part) <= LONGEST:
                self.remembered[part] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        segments = self.segments(_MARK + text.replace(" ", _MARK))
        total, seen, old = text.count("\n"), self.remembered, self.older
        for segment, n in zip(segments, map(seen.get, segments), strict=True):
            if n is None:
                n = old.get(segment) or self.parted(segment)
                if len(segment) <= LONGEST:
                    seen[segment] = n
            total += n
        if len(seen) >= REMEMBERED:  # what is still in use comes back from the older ones
            self.remembered, self.older = {}, seen
        return total


_loaded: dict[str, BytePairs] = {}


def counter(path: str) -> BytePairs:
    if path not in _loaded:
        _loaded[path] = BytePairs(path)
    return _loaded[path]


def token_counts(docs: DataFrame, model: str, over: int = OVER) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of each row of docs (doc_id, text); model: the file's path on the executors."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = counter(model)
        for batch in batches:
            n = [pairs.count(x or "") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array([x > over for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
