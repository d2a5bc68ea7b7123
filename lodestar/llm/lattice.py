"""Segmentations of words over a fixed piece vocabulary, many words at a time.

Words of equal length advance together: a block of ``B`` words of ``L``
characters is one matrix, every substring of it is hashed by prefix sums, and
the hashes are looked up in the sorted hashes of the vocabulary's pieces.  The
recursions then run over character positions with one numpy step for all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SPACE = "▁"            # how the vocabulary writes a space
NEVER = -1e300
_BASE = 0x9E3779B97F4A7C15
_FILTER_BITS = 20
# Entries of the (words, positions, piece lengths) block that is held at once.
BLOCK_ENTRIES = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Pieces:
    """A vocabulary for lookups: sorted substring hashes, ids and scores.

    ``pieces[i]`` has id ``ids[i]`` and score ``scores[i]``.  A character that
    is no piece is spelled by the byte pieces of its UTF-8 form, which score
    ``byte_scores[b]`` and have the ids ``byte_ids[b]``.
    """

    def __init__(self, pieces: list[str], ids: list[int], scores: np.ndarray,
                 byte_ids: np.ndarray, byte_scores: np.ndarray):
        self.longest = max(map(len, pieces))
        self.power = np.array([pow(_BASE, i, 2**64) for i in range(self.longest + 1)], np.uint64)
        keys = np.array([self._hash(p) for p in pieces], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        if np.any(self.keys[1:] == self.keys[:-1]):
            raise ValueError("two pieces have one hash")
        self.order = order
        self.ids = np.asarray(ids, np.int64)[order]
        self.byte_ids = np.asarray(byte_ids, np.int64)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.rescore(scores, byte_scores)

    def rescore(self, scores: np.ndarray, byte_scores: np.ndarray) -> None:
        self.scores = np.append(np.asarray(scores, np.float64)[self.order], NEVER)
        self.byte_scores = np.asarray(byte_scores, np.float64)

    def _hash(self, piece: str) -> int:
        codes = np.array([ord(c) for c in piece], np.uint64) + np.uint64(1)
        total = np.sum(_mix(codes) * self.power[len(piece) - 1::-1][:len(piece)])
        return int(_mix(np.array([total], np.uint64) + np.uint64(len(piece)))[0])

    def lookup(self, codes: np.ndarray) -> np.ndarray:
        """``(longest, B, L)`` piece numbers: ``[k-1, :, i]`` for the substring of ``k``
        characters that ends after character ``i``; -1 (the last score) for none."""
        n, length = codes.shape
        deep = min(self.longest, length)
        out = np.full((deep, n, length), -1, np.int32)
        char = _mix(codes.astype(np.uint64) + np.uint64(1))
        h = np.zeros((n, length), np.uint64)
        for k in range(1, deep + 1):
            # hash of k characters ending at i = the first k-1 of them shifted, plus the last
            if k == 1:
                h = char.copy()
            else:
                h = h[:, :-1] * np.uint64(_BASE) + char[:, k - 1:]
            # h[:, j] now covers characters j .. j+k-1
            full = _mix(h + np.uint64(k))
            maybe = self.filter[(full >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
            if not maybe.any():
                continue
            key = full[maybe]
            at = np.searchsorted(self.keys, key)
            at[at == len(self.keys)] = 0
            found = np.where(self.keys[at] == key, at, -1).astype(np.int32)
            view = out[k - 1][:, k - 1:]
            view[maybe] = found
        return out

    def byte_cost(self, codes: np.ndarray) -> np.ndarray:
        """Score of spelling each character by its bytes."""
        flat, back = np.unique(codes, return_inverse=True)
        cost = np.array([self.byte_scores[list(_utf8(int(c)))].sum() for c in flat])
        return cost[back].reshape(codes.shape)


def _utf8(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass")


def blocks_by_length(words: list[str], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(numbers of the words, code point matrix)`` for words of equal length."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    bounds = np.flatnonzero(np.diff(lengths[order])) + 1
    for same in np.split(order, bounds):
        if not len(same) or not lengths[same[0]]:
            continue
        length = int(lengths[same[0]])
        step = max(1, BLOCK_ENTRIES // (length * min(longest, length)))
        for a in range(0, len(same), step):
            some = same[a:a + step]
            text = "".join([words[i] for i in some])
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
            yield some, codes.reshape(len(some), length)


def _arc_scores(pieces: Pieces, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found = pieces.lookup(codes)
    score = pieces.scores[found]
    spelled = found[0] < 0
    if spelled.any():
        score[0][spelled] = pieces.byte_cost(codes[spelled])
    return found, score


def _stripe(pieces: Pieces, codes: np.ndarray) -> int:
    """How many positions of a block are looked up at once (all, but for very long words)."""
    return max(pieces.longest, BLOCK_ENTRIES // (len(codes) * pieces.longest))


def _arcs(pieces: Pieces, codes: np.ndarray):
    """``(a, b, found, score)`` of the pieces that end after the characters ``a .. b-1``."""
    length, step = codes.shape[1], _stripe(pieces, codes)
    for a in range(0, length, step):
        b = min(a + step, length)
        lead = min(a, pieces.longest - 1)
        found, score = _arc_scores(pieces, codes[:, a - lead:b])
        yield a, b, found[:, :, lead:], score[:, :, lead:]


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=0)
    return top + np.log(np.exp(x - top).sum(axis=0))


def _forward(pieces: Pieces, codes: np.ndarray) -> np.ndarray:
    """``alpha[:, i]``: log of the summed weight of all segmentations of i characters."""
    n, length = codes.shape
    alpha = np.full((n, length + 1), NEVER)
    alpha[:, 0] = 0
    for a, b, _, score in _arcs(pieces, codes):
        for i in range(a + 1, b + 1):
            k = min(len(score), i)
            # piece of j characters ends at i: alpha[i-j] + score[j-1, :, i-1]
            arrive = score[:k, :, i - 1 - a] + alpha[:, i - k:i][:, ::-1].T
            alpha[:, i] = _log_sum(arrive)
    return alpha


def log_marginals(pieces: Pieces, words: list[str]) -> np.ndarray:
    """Log of the total weight of all segmentations of each word (0 for an empty one)."""
    out = np.zeros(len(words))
    for some, codes in blocks_by_length(words, pieces.longest):
        out[some] = _forward(pieces, codes)[:, -1]
    return out


def expected_counts(pieces: Pieces, words: list[str], weights: np.ndarray) -> tuple:
    """Expected number of each piece (in sorted-key order) and byte over all
    segmentations, each word counted ``weights`` times."""
    total = np.zeros(len(pieces.keys) + 1)
    spelled_chars: dict[int, float] = {}
    for some, codes in blocks_by_length(words, pieces.longest):
        n, length = codes.shape
        step = _stripe(pieces, codes)
        alpha = _forward(pieces, codes)
        beta = np.full((n, length + 1), NEVER)
        beta[:, length] = 0
        weight = weights[some].astype(np.float64)
        for a in range((length - 1) // step * step, -1, -step):
            # pieces that start at a character of this stripe may end in the next
            found, score = _arc_scores(pieces, codes[:, a:a + step + pieces.longest - 1])
            for i in range(min(a + step, length) - 1, a - 1, -1):
                k = min(len(score), length - i)
                # piece of j characters starts at i: score[j-1, :, i+j-1] + beta[i+j]
                ends = np.arange(i - a, i - a + k)
                leave = score[np.arange(k), :, ends] + beta[:, i + 1:i + k + 1].T
                beta[:, i] = _log_sum(leave)
                share = np.exp(np.minimum(leave + alpha[:, i] - alpha[:, length], 0)) * weight
                number = found[np.arange(k), :, ends]
                ok = number >= 0
                np.add.at(total, number[ok], share[ok])
                lone = number[0] < 0
                if lone.any():
                    for c, s in zip(codes[lone, i].tolist(), share[0][lone].tolist()):
                        spelled_chars[c] = spelled_chars.get(c, 0.0) + s
    by_byte = np.zeros(256)
    for c, s in spelled_chars.items():
        for b in _utf8(c):
            by_byte[b] += s
    return total[:-1], by_byte


def best_paths(pieces: Pieces, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words' best segmentations (Viterbi), back to back, and the
    number of ids of each word.

    Ties go to the longest last piece.  Backpointers are the arg-maxima of the
    same vectorised step, followed for all words of a block at once.
    """
    ids, places = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
    for some, codes in blocks_by_length(words, pieces.longest):
        n, length = codes.shape
        best = np.full((n, length + 1), NEVER)
        best[:, 0] = 0
        back = np.zeros((n, length + 1), np.int32)
        piece = np.zeros((n, length + 1), np.int32)
        every = np.arange(n)
        for a, b, found, score in _arcs(pieces, codes):
            for i in range(a + 1, b + 1):
                k = min(len(score), i)
                arrive = score[:k, :, i - 1 - a] + best[:, i - k:i][:, ::-1].T
                pick = k - 1 - np.argmax(arrive[::-1], axis=0)      # the longest of equals
                back[:, i] = pick + 1
                piece[:, i] = found[pick, every, i - 1 - a]
                best[:, i] = arrive[pick, every]
        ends = np.zeros((n, length + 1), bool)
        at, rows = np.full(n, length), every
        while len(rows):
            ends[rows, at[rows]] = True
            at[rows] -= back[rows, at[rows]]
            rows = rows[at[rows] > 0]
        row, end = np.nonzero(ends)
        number = piece[row, end]
        place = (some[row] << 32 | end) << 3        # by word, by place, up to 8 ids at one
        known = number >= 0
        ids.append(pieces.ids[number[known]].astype(np.uint32))
        places.append(place[known])
        if not known.all():
            chars, which = np.unique(codes[row[~known], end[~known] - 1], return_inverse=True)
            spelling = [pieces.byte_ids[list(_utf8(int(c)))].astype(np.uint32) for c in chars]
            for w, first in zip(which.tolist(), place[~known].tolist()):
                ids.append(spelling[w])
                places.append(first + np.arange(len(spelling[w])))
    flat, place = np.concatenate(ids), np.concatenate(places)
    order = np.argsort(place)
    return flat[order], np.bincount(place >> 35, minlength=len(words))


def best_segmentations(pieces: Pieces, words: list[str]) -> list[list[int]]:
    """The ids of each word's best segmentation, see :func:`best_paths`."""
    flat, size = best_paths(pieces, words)
    return [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])] if words else []


def load_vocabulary(path: str, max_score: float = -1e8) -> tuple[Pieces, list[str]]:
    """The pieces of a SentencePiece model file and the text of every id.

    Control pieces are left out, byte pieces spell what no other piece covers.
    Byte pieces without a score of their own get the worst score less 10, as
    SentencePiece gives an unknown character.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    scores = np.array([model.get_score(i) for i in range(size)])
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i)
                                            or model.is_unknown(i) or model.is_unused(i))]
    usable = scores[plain]
    floor = usable[usable > max_score].min()
    # sentinel scores (pieces the trainer never merged into) rank after all others
    usable = np.where(usable > max_score, usable, floor - 1)
    pieces = Pieces([names[i] for i in plain], plain, usable, byte_ids,
                    np.full(256, floor - 10.0))
    return pieces, names
