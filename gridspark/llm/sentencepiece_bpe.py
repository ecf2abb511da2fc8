"""Operator 7: SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs whose union is a piece, ordered by score and then from the left;
the best is merged, its neighbours enter the agenda, and entries whose symbols have changed are passed over.  What is
left and is no piece becomes byte pieces.

The normaliser must be the identity with escaped white space (checked).  If no piece has a space mark after another
character (checked too), no merge crosses from a word to the mark after it; so each run of marks with the word behind it
is encoded alone, once for each worker's cache.  Otherwise the agenda runs over the whole text.  In each Arrow batch what
was new to the cache is encoded and decoded by the sentencepiece library as well; ``differ`` says whose
ids and decoded texts are used where the two differ ("library"), or that this is an error ("raise").

Defined results: a null text is empty and has no ids; repeated rows are encoded row by row; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import map_batches, resident, trimmed

MARK = "▁"
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
INF = float("inf")
#: Words that a worker's cache holds; a new one costs the agenda and the library's calls.
ENTRIES = 400_000
#: Characters up to which the agenda is a list.
LIST = 48
_NORMAL, _BYTE = 1, 6
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")


class Codec:
    """One for each worker."""

    def __init__(self, path: str, entries: int = ENTRIES, differ: str = "library"):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        n = model.normalizer_spec
        if model.trainer_spec.model_type != model.trainer_spec.BPE or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces or not n.add_dummy_prefix or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path}: not a merge-type vocabulary with an identity normaliser and a leading mark")
        if {p.type for p in model.pieces} - {_NORMAL, 2, 3, _BYTE}:
            raise ValueError(f"{path}: user-defined or unused pieces aren't supported")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.piece = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.score = {p: -model.pieces[i].score for p, i in self.piece.items()}.get  # the least is merged first
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == _BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == 2)
        self.by_unit = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.piece)
        #: What an id stands for when decoded; control pieces for nothing.
        self.surface = [p.piece.replace(MARK, " ") if p.type == _NORMAL else " ⁇ " if p.type == 2 else "" for p in model.pieces]
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.entries, self.differ, self.differed = entries, differ, 0
        self.known: dict[str, tuple[int, str, str]] = {}

    def merge(self, unit: str) -> list[int]:
        """The ids of an escaped text by the agenda: a plain list of the pairs from left to right while that is short."""
        return self.ids(self.by_list(unit) if len(unit) <= LIST else self.by_heap(unit))

    def by_list(self, unit: str) -> list[str]:
        score, symbols = self.score, list(unit)
        agenda = [score(a + b, INF) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := min(agenda)) != INF:
            i = agenda.index(best)  # of equal scores the left one
            whole = symbols[i] = symbols[i] + symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = score(symbols[i - 1] + whole, INF)
            if i < len(agenda):
                agenda[i] = score(whole + symbols[i + 1], INF)
        return symbols

    def by_heap(self, unit: str) -> list[str]:
        score, symbols = self.score, list(unit)
        left, right = [*range(-1, len(symbols) - 1)], [*range(1, len(symbols) + 1)]
        agenda = [(s, i, unit[i : i + 2]) for i in range(len(unit) - 1) if (s := score(unit[i : i + 2], INF)) != INF]
        heapq.heapify(agenda)
        while agenda:
            _, i, whole = heapq.heappop(agenda)
            j = right[i] if symbols[i] else len(symbols)
            if j >= len(symbols) or symbols[i] + symbols[j] != whole:
                continue
            symbols[i], symbols[j] = whole, ""
            right[i] = k = right[j]
            if k < len(symbols):
                left[k] = i
                if (s := score(whole + symbols[k], INF)) != INF:
                    heapq.heappush(agenda, (s, i, whole + symbols[k]))
            if (h := left[i]) >= 0 and (s := score(symbols[h] + whole, INF)) != INF:
                heapq.heappush(agenda, (s, h, symbols[h] + whole))
        return [x for x in symbols if x]

    def ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for x in symbols:
            if (i := self.piece.get(x)) is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in x.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def units(self, text: str) -> list[str]:
        """The parts that are encoded alone, without the mark that opens each; joined by marks they are the text."""
        if not text:
            return []
        text = text.replace(MARK, " ")
        if not self.by_unit:
            return [text]
        units = text.split(" ")
        return units if "" not in units else [u[1:].replace(MARK, " ") for u in _UNIT.findall(MARK + text.replace(" ", MARK))]

    def learn(self, units: list[str]) -> None:
        """Encodes new units and holds them against the library."""
        every = self.library.encode(units, num_threads=1)
        for u, theirs, back in zip(units, every, self.library.decode(every, num_threads=1) if every else [], strict=True):
            ours = self.merge(MARK + u.replace(" ", MARK))
            if ours != theirs and u:  # the library gives no ids for an empty text; a lone mark is none
                if self.differ == "raise":
                    raise ValueError(f"{u!r}: {ours}, the library gives {theirs}")
                self.differed, ours = self.differed + 1, theirs
            text = self.surfaces(ours)
            if text[1:] != back and u:
                if self.differ == "raise":
                    raise ValueError(f"{u!r}: decoded to {text[1:]!r}, by the library to {back!r}")
                self.differed, text = self.differed + 1, f" {back}"
            self.known[u] = len(ours), ",".join(map(str, ours)), text

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """For each text the number of its ids, the ids joined by commas, and what they decode to."""
        split = [self.units(t) for t in texts]
        self.learn(new := [u for u in set().union(*split) if u not in self.known])
        known, out = self.known, []
        for p in split:
            found = [known[u] for u in p]
            text = "".join([x[2] for x in found])
            out.append((sum(x[0] for x in found), ",".join([x[1] for x in found]), text[1:]))
        self.known = trimmed(known, new, self.entries)
        return out

    def surfaces(self, ids: list[int]) -> str:
        """The ids' characters with all spaces; bytes that are no UTF-8 become replacement characters."""
        out, run = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_replaced(bytes(run)))
                run.clear()
            if i is not None:
                out.append(self.surface[i])
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: as they are, but for the mark that opens the first piece."""
        text = self.surfaces(ids)
        first = next((i for i in ids if self.surface[i] or i in self.byte_of), None)
        return text[1:] if first is not None and self.surface[first][:1] == " " and first != self.unknown else text


def _replaced(data: bytes) -> str:
    """UTF-8, with one replacement character for each byte that starts no character."""
    try:
        return data.decode()
    except UnicodeDecodeError as e:
        return data[: e.start].decode() + "�" + _replaced(data[e.start + 1 :])


def codec(path: str, differ: str = "library") -> Codec:
    return resident(("sentencepiece", path, differ), lambda: Codec(path, differ=differ))


def encode_decode(docs: DataFrame, model_path: str, differ: str = "library") -> DataFrame:
    """docs with n_tokens, ids (joined by commas) and decoded beside its columns; clashing names are replaced."""
    kept = [c for c in docs.columns if c not in ("n_tokens", "ids", "decoded")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = codec(model_path, differ).encode([t or "" for t in batch.column("text").to_pylist()])
        columns = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.large_string()), pa.array([x[2] for x in out], pa.large_string())]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, "n_tokens", "ids", "decoded"])

    docs = docs.select(kept)
    return map_batches(docs, run, T.StructType([*docs.schema.fields, *T.StructType.fromDDL("n_tokens long, ids string, decoded string")]))


def digests(docs: DataFrame, model_path: str, differ: str = "library") -> DataFrame:
    """One row for each of docs(doc_id, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = codec(model_path, differ).encode([t or "" for t in batch.column("text").to_pylist()])
        sha = [pa.array([hashlib.sha256(x[k].encode()).hexdigest() for x in out]) for k in (1, 2)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), *sha], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, SCHEMA)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
