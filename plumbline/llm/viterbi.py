"""SentencePiece vocabularies, encoded by a streaming Viterbi and decoded again.

A text is a lattice: from every position lead the pieces that match there, and characters that are no piece lead on by
their bytes. The best path has the highest sum of scores, and of equal ones the longest last piece. The encoder keeps a
window of a few times the longest piece's length; whenever the paths of all positions in it come from one boundary, the
ids up to there are final and leave the window: at once where no path goes beyond the position that is reached, and by
following the paths back where the window is full. Its memory does not grow with the text, and all ids come from it.

Where no piece can cross a boundary all paths converge there, whatever follows. Texts are cut at such places first, before
runs of spaces and around line ends, if the vocabulary has no piece that spans them; what lies between is remembered.

As in SentencePiece, a space is the sign U+2581, and one is put before a text that is not empty. That sign itself goes by
its bytes, so decoding gives back every text exactly. The vocabulary's file is a parameter.

Defined cases: text NULL counts as empty; an empty text has no ids. Rows with the same id stay apart.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SPACE = "▁"
#: A character by its bytes scores this much less, for each byte, than the poorest piece.
BYTE_PENALTY = 10
REMEMBERED, LONGEST_REMEMBERED = 200_000, 32

ENCODED = "doc_id long, n_tokens long, n_byte_tokens long, ids array<int>, decoded_sha256 string, exact boolean"


class Lattice:
    """The pieces of a vocabulary: {piece: (id, score)} with whole scores, and the ids of the 256 bytes."""

    def __init__(self, pieces: dict[str, tuple[int, int]], byte_ids: list[int]):
        self.pieces, self.byte_ids = pieces, byte_ids
        self.longest = max(map(len, pieces), default=1)
        # a tree of the pieces' characters: {character: [further characters, id and score if a piece ends here]}
        self.tree: dict = {}
        for piece, (number, score) in pieces.items():
            below = self.tree
            for c in piece:
                node = below.setdefault(c, [{}, None, 0])
                below = node[0]
            node[1:] = number, score
        self.byte_score = min((s for _, s in pieces.values()), default=0) - BYTE_PENALTY
        spans = {c for p in pieces if len(p) > 1 for c in p}
        apart = "".join(c for c in "\n\t\r\v\f" if c not in spans)
        lone = f"[{apart}]|" if apart else ""
        if any(SPACE in p.lstrip(SPACE) for p in pieces):  # a piece goes on after a space: no place is safe
            self.parts = None
        else:
            self.parts = re.compile(f"{lone}{SPACE}*[^{SPACE}{apart}]+|{SPACE}+").findall
        self.memory = _Memory(self)
        signs: dict[int, bytes] = {i: p.replace(SPACE, " ").encode() for p, (i, _) in pieces.items()}
        signs |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.signs = signs

    def stream(self, text: Iterable[str]) -> Iterator[int]:
        """Ids of a text that comes as characters."""
        longest, tree = self.longest, self.tree
        source = iter(text)
        window = list(islice(source, 2 * longest))  # characters that are not final yet
        ended = len(window) < 2 * longest
        n = len(window)
        best: list = [0] + [None] * n  # scores of the best paths to the window's positions
        came: list = [0] * (n + 1)  # where their last steps start
        step: list = [None] * (n + 1)  # and what these are: a piece's id, or a list of the ids of bytes
        done = 0  # positions before it have led on to all pieces that match there
        reach = 0  # the furthest position that they have led to
        while True:
            if not ended and n - done < longest:
                more = list(islice(source, longest))
                ended = len(more) < longest
                window += more
                best += [None] * len(more)
                came += [0] * len(more)
                step += [None] * len(more)
                n = len(window)
            if done == n:
                return
            # steps from a position: all pieces that start there, or its character's bytes
            score, below, to = best[done], tree, done
            while to < n:
                node = below.get(window[to])
                if node is None:
                    break
                below, number, worth = node
                to += 1
                if number is not None:
                    total, old = score + worth, best[to]
                    if old is None or total > old:
                        best[to], came[to], step[to] = total, done, number
                    if to > reach:
                        reach = to
            first = tree.get(window[done])
            done += 1
            if first is None or first[1] is None:
                raw = window[done - 1].encode()
                total = score + self.byte_score * len(raw)
                if best[done] is None or total > best[done]:
                    best[done], came[done], step[done] = total, done - 1, [self.byte_ids[b] for b in raw]
                if done > reach:
                    reach = done
            if reach == done:  # no path goes beyond this boundary, so all lead through it
                cut = done
            elif done >= 2 * longest:
                # positions that a path can still lead on from; their paths are followed back until one boundary is left
                open_ = {i for i in range(done, reach + 1) if best[i] is not None}
                while len(open_) > 1:
                    far = max(open_)
                    open_.remove(far)
                    open_.add(came[far])
                cut = open_.pop()
            else:
                continue
            if not cut:
                continue
            out, at = [], cut
            while at:
                found = step[at]
                if type(found) is list:
                    out.extend(reversed(found))
                else:
                    out.append(found)
                at = came[at]
            out.reverse()
            yield from out
            if cut == n and ended:
                return  # most texts are words that end here
            del window[:cut], best[:cut], step[:cut]
            came = [x - cut for x in came[cut:]]
            n, done, reach = n - cut, done - cut, reach - cut

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if SPACE in text:
            first, *rest = text.split(SPACE)
            sign = np.array([self.byte_ids[b] for b in SPACE.encode()], np.int32)
            parts = [self._encode(SPACE + first.replace(" ", SPACE))]
            for part in rest:
                parts += [sign, self._encode(part.replace(" ", SPACE))]
            return np.concatenate(parts)
        return self._encode(SPACE + text.replace(" ", SPACE))

    def _encode(self, marked: str) -> np.ndarray:
        if self.parts is None:
            return np.fromiter(self.stream(marked), np.int32)
        return np.frombuffer(b"".join(map(self.memory.__getitem__, self.parts(marked))), np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.signs.__getitem__, ids)).decode()[1:]


class _Memory(dict):
    """Ids of parts of texts, as bytes. When it is full, what was asked for since it was last full is kept."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = array("i", self.lattice.stream(part)).tobytes()
        if len(part) <= LONGEST_REMEMBERED:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[part] = ids
        return ids


@cache
def lattice(path: str) -> Lattice:
    """One for each Python worker, whatever the number of its tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids = {}, [0] * 256
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_unknown(i) or model.is_control(i) or model.is_unused(i)):
            pieces[piece] = (i, round(model.get_score(i)))
    return Lattice(pieces, byte_ids)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """Per row of (doc_id, text): its ids, their number, how many are single bytes, and the digest of the text decoded from
    them; `exact` says whether that is the text again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(path)
        is_byte = np.zeros(max(own.signs, default=0) + 1, bool)
        is_byte[own.byte_ids] = True
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids = [own.encode(t) for t in texts]
            back = [own.decode(i.tolist()) for i in ids]
            ends = np.cumsum([0, *map(len, ids)])
            if ends[-1] >= 1 << 31:
                raise ValueError("a batch has more ids than an Arrow list can hold")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array([int(is_byte[i].sum()) for i in ids], pa.int64()),
                    pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back], pa.string()),
                    pa.array([a == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
                ],
                names=["doc_id", "n_tokens", "n_byte_tokens", "ids", "decoded_sha256", "exact"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)
