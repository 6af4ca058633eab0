"""Token counts by byte-pair merging with a heap over a linked list of symbols.

The vocabulary comes from a sentencepiece BPE model file; the merging is done here, and no
identifiers are made: a text has as many tokens as it has symbols less the merges, where a character
outside the vocabulary counts one token per UTF-8 byte.
"""

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.common import steps
from tagloom.staging import ship_package

SPACE = "▁"
#: Counts of so many chunks stay in a Python worker's memory; beyond that it starts anew.
CACHED_CHUNKS = 800_000
#: Longer chunks are counted each time.
CACHED_LENGTH = 48
_counters = {}


class MergeCounter(dict):
    """Token counts of chunks, kept as they are asked for.

    A key stands for itself after a space; one that starts with a line feed stands for that line feed
    and an unprefixed rest.
    """

    def __init__(self, model_path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        normal = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        scores = sorted({model.get_score(i) for i in normal}, reverse=True)
        order = {score: rank for rank, score in enumerate(scores)}
        # Equal scores share a rank: the leftmost pair then comes first.
        self.ranks = {model.id_to_piece(i): order[model.get_score(i)] for i in normal}
        # No piece crosses from a non-space to a space mark, or a line feed: chunks merge on their own.
        self.splits = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ranks)

    def __missing__(self, key):
        n = 1 + self.merged(key[1:]) if key[:1] == "\n" else self.merged(SPACE + key)
        if len(key) <= CACHED_LENGTH:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[key] = n
        return n

    def merged(self, chunk):
        """Symbols of a chunk less its merges."""
        n = len(chunk)
        ranks = self.ranks
        symbols = list(chunk)
        left = sum(1 if s in ranks else len(s.encode()) for s in symbols)
        if n < 2:
            return left
        shift = n.bit_length()
        mask = (1 << shift) - 1
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbols[i] + symbols[i + 1])
            if rank is not None:
                heap.append(((rank << shift | i) << shift) | 2)
        if not heap:
            return left
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            i = entry >> shift & mask
            a = symbols[i]
            j = after[i]
            if a is None or j == n:
                continue
            pair = a + symbols[j]
            if len(pair) != entry & mask:
                continue  # a neighbour has changed since
            symbols[i], symbols[j] = pair, None
            left -= 1
            k = after[i] = after[j]
            if k != n:
                before[k] = i
                both = pair + symbols[k]
                rank = ranks.get(both)
                if rank is not None:
                    heappush(heap, ((rank << shift | i) << shift) | len(both))
            h = before[i]
            if h >= 0:
                both = symbols[h] + pair
                rank = ranks.get(both)
                if rank is not None:
                    heappush(heap, ((rank << shift | h) << shift) | len(both))
        return left

    def count(self, text):
        """Tokens of a whole text."""
        if not text:
            return 0
        if self.splits and not (SPACE in text or "  " in text or text[0] == " " or " \n" in text):
            return sum(map(self.__getitem__, text.replace("\n", " \n").split(" ")))
        whole = SPACE + text.replace(" ", SPACE)
        if not self.splits:
            return self.merged(whole)
        total = 0
        for chunk in re.findall(rf"\n|{SPACE}[^{SPACE}\n]+|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+", whole):
            if chunk == "\n":
                total += 1
            elif chunk[0] == SPACE and chunk[1:2] != SPACE:
                total += self[chunk[1:]]
            else:
                total += self.merged(chunk)
        return total


def _counter(model_path):
    if model_path not in _counters:
        _counters[model_path] = MergeCounter(model_path)
    return _counters[model_path]


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row; other columns are left out.

    A null text counts as empty: no bytes, no tokens. Repeated rows and null ids come back as they
    are. One pass without a shuffle; each text is counted whole.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        counter = _counter(model_path)
        for part in steps(batches):
            texts = part.column("text").to_pylist()
            tokens = [counter.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
