"""Abusive, hateful or sexual content by the nearest labelled examples.

Documents are cut into passages (about a sentence each), as a single line can make
a long text a case.  One pass over all texts turns every passage into term counts and
counts the documents of each term.  A passage's neighbours are all passages of labelled
documents with a TF-IDF cosine of at least ``RADIUS``, found exactly by an inverted index
with block maxima: only the heaviest terms of a passage, without which no cosine can
reach the radius, are looked up, and only blocks whose bound reaches it are computed.
Distance-weighted votes of the ``NEAREST``, where equally near ones share the last places, are mapped to a probability by a logistic
curve fitted on the labelled documents, each scored without its own vote; the nearest unwanted example
is the evidence.

Labels hold for whole documents, so the examples first vote on each other: a passage
of an unwanted document counts as unwanted only as far as passages like it do not
occur in clean ones, and the likeliest passage of each document does unless clean
examples clearly outvote it.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.visual_form import canonical
from quillon.storage import Scratch

#: Bound of the labelled sample that is fitted: documents, taken by hash of their id.
MAX_LABELLED = 8000
#: Least cosine of a neighbour, neighbours that vote, exponent of the cosine in a vote, weight of a vote for nothing.
RADIUS, NEAREST, SHARPNESS, NO_VOTE = 0.4, 12, 4, 0.5
#: Cosines no further apart are equal: they differ by the order of their sums only.
TIE = 1e-9
#: What a passage of an unwanted document is believed to be before any example votes; below half of it the label is held wrong.
UNSEEN = 0.5
#: Fitted probability from which a document is a case.
THRESHOLD = 0.5
#: Terms in less than this share of all documents, unknown ones included, weigh alike.
RARE = 0.02
CLEAN = "none"

# Signs that stand for letters.
_SUBSTITUTES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"})
_REPEAT = re.compile(r"([^\W\d_])\1{2,}")
_IDEOGRAPH = r"\p{Han}\p{Hiragana}\p{Katakana}"
_SPELLED = regex.compile(r"(?:\p{L}[.\-_*·]){2,}\p{L}")
#: What a token between blanks may hold: ideographs, words, ends of a passage.
_INNER = regex.compile(
    rf"(?P<run>[{_IDEOGRAPH}]+)|(?P<word>[[\p{{L}}\p{{M}}\p{{N}}\p{{Cf}}*@$]--[{_IDEOGRAPH}]]+)"
    r"|(?P<stop>[.!?…]['\"”»)]*$|[。！？।؟]['\"”»」）]*)", regex.V1,
)
#: The commonest kind of token.
_PLAIN_WORD = re.compile(r"([A-Za-z]+)[,;:]?([.!?]['\")]*)?")
_CAPITAL = re.compile(r"\w[\w’']*")
_LINE, _TEXT = "\ue001", "\ue002"
#: A code is a term's id with flags: the passage ends after it, it is a known opening word, it ends in a letter or digit,
#: it is a single letter; or the index of a token of several parts.
_ID = (1 << 40) - 1
_STOP, _OPENS, _PLAIN, _SINGLE, _MULTI, _ENDS = (1 << k for k in range(41, 47))


def _term(raw: str) -> str | None:
    """One spelling of a word: look-alikes, case, masked and stretched letters undone; None for no word."""
    text = _REPEAT.sub(r"\1\1", canonical(raw).casefold())
    if text.isalpha():
        return text
    if text.isdigit():
        return "0"
    if not any(c.isalnum() for c in text):
        return None
    return text.translate(_SUBSTITUTES) if any(c.isalpha() for c in text) else text


def _parts(raw: str) -> list[tuple[str | None, int]]:
    """Terms of a token between blanks, and ``(None, offset)`` where a passage ends after ``offset`` characters."""
    if raw == _LINE:
        return [(None, 1)]
    if m := _PLAIN_WORD.fullmatch(raw):
        word = (_REPEAT.sub(r"\1\1", m.group(1).lower()), 0)
        return [word, (None, len(raw))] if m.group(2) else [word]
    core = raw.strip(".,;:!?…\"'()«»“”„")
    if _SPELLED.fullmatch(core):
        out: list[tuple[str | None, int]] = [("".join(c for c in canonical(core).casefold() if c.isalnum()), 0)]
        return out + [(None, len(raw))] * (_INNER.search(raw, raw.find(core) + len(core)) is not None and raw[-1] not in ",;:")
    out = []
    for m in _INNER.finditer(raw):
        if m.group("stop"):
            out.append((None, m.end()))
        elif m.group("run"):
            run = canonical(m.group())
            out.extend((run[i : i + 2], 0) for i in range(max(1, len(run) - 1)))
        elif (word := _term(m.group())) is not None:
            out.append((word, 0))
    return out


def _flags(raw: str, parts: list[tuple[str | None, int]], openers: frozenset[str]) -> int:
    plain = raw[-1].isalnum() or raw[-1] == "!"
    single = len(parts) > 0 and parts[0][0] is not None and len(parts[0][0]) == 1 and raw[0].isalpha() and all(t is None for t, _ in parts[1:])
    return _PLAIN * plain + _SINGLE * single + _OPENS * (raw in openers)


def _stream(text: str, openers: frozenset[str]) -> Iterator[tuple[int, int, str | None]]:
    """``(start, end, term)`` in order; the term is None where a passage ends at ``end``."""
    held: list[tuple[int, int, str]] = []
    plain, since = False, 0

    def spelled() -> Iterator[tuple[int, int, str]]:
        if len(held) >= 4:
            yield held[0][0], held[-1][1], "".join(t for _, _, t in held)
        else:
            yield from held
        held.clear()

    for m in _BLANKS.finditer(text):
        raw, at = m.group(), m.start()
        if raw in "\n\r":
            raw = _LINE
        parts = _parts(raw)
        flags = _flags(raw, parts, openers)
        if not (flags & _SINGLE and (plain or not held)):
            yield from spelled()
        if flags & _OPENS and plain and since >= 2:
            yield from spelled()
            yield at, at, None
        stops = False
        for term, offset in parts:
            if term is None:
                yield from spelled()
                stops = True
                yield at, at + offset, None
            elif flags & _SINGLE:
                held.append((at, m.end(), term))
            else:
                yield at, m.end(), term
        since = 0 if stops else since + 1
        plain = bool(flags & _PLAIN)
    yield from spelled()


_BLANKS = re.compile(r"[^\s\x00]+|[\n\r]")


def terms(passage: str) -> list[str]:
    """Terms of a passage in order; ideographs two by two, spelled-out words whole."""
    return [term for _, _, term in _stream(passage, frozenset()) if term is not None]


def passages(text: str | None, openers: frozenset[str] = frozenset()) -> list[str]:
    """Passages of a text: cut after terminators and at lines, and where a known opening word follows without a stop."""
    return [text[a:b].strip() for a, b in _spans(text, openers) if text[a:b].strip()] if text else []


def _spans(text: str, openers: frozenset[str]) -> list[tuple[int, int]]:
    """Where the passages are, blank ones included, numbered as ``Reader`` numbers them."""
    cuts = [0, *(end for _, end, term in _stream(text, openers) if term is None), len(text)]
    return list(zip(cuts, cuts[1:]))


class Reader:
    """Turns batches of texts into term counts by passage; each distinct token is analysed once."""

    #: Tokens kept at most; the memory is emptied beyond it, which changes no result.
    KEPT = 300_000

    def __init__(self, ids: dict[str, int], openers: frozenset[str], grows: bool = False):
        """``grows``: unknown terms enter ``ids``."""
        self.ids, self.openers, self.width, self.grows = ids, openers, len(ids), grows
        self.codes: dict[str, int] = {}
        self.multi: list[list[tuple[str | None, int]]] = []

    def id_of(self, term: str) -> int:
        if self.grows:
            return self.ids.setdefault(term, len(self.ids))
        known = self.ids.get(term)
        # Unknown terms are told apart by a hash above all known ones.
        return self.width + zlib.crc32(term.encode()) if known is None else known

    def _code(self, raw: str) -> int:
        if raw == _TEXT:
            return _ID | _STOP | _ENDS
        if m := _PLAIN_WORD.fullmatch(raw):
            word, stop = m.groups()
            code = self.id_of(_REPEAT.sub(r"\1\1", word.lower())) | _STOP * (stop is not None)
            return code | _PLAIN * (raw[-1].isalpha() or raw[-1] == "!") | _SINGLE * (len(word) == 1) | _OPENS * (raw in self.openers)
        parts = _parts(raw)
        flags = _flags(raw, parts, self.openers)
        if not parts:
            return _ID | flags
        if len(parts) == 1 and parts[0][0] is None:
            return _ID | _STOP | flags
        if parts[0][0] is not None and (len(parts) == 1 or len(parts) == 2 and parts[1][0] is None):
            return self.id_of(parts[0][0]) | flags | _STOP * (len(parts) == 2)
        self.multi.append(parts)
        return (len(self.multi) - 1) | flags | _MULTI

    def _tokens(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, list[tuple[int, list]]]:
        """Tokens between blanks, their codes, the passages that end in each, and the tokens of several parts."""
        codes = self.codes
        if len(codes) > self.KEPT:
            codes.clear()
            self.multi.clear()
        joined = f" {_TEXT} ".join((t or "").replace(_TEXT, " ").replace(_LINE, " ") for t in texts)
        found = joined.replace("\0", " ").replace("\n", f" {_LINE} ").replace("\r", f" {_LINE} ").split()
        for raw in set(found).difference(codes):
            codes[raw] = self._code(raw)
        code = np.fromiter(map(codes.__getitem__, found), np.int64, len(found))
        stops = ((code & _STOP) > 0).astype(np.int64)
        multi = [(i, self.multi[int(code[i] & _ID)]) for i in np.flatnonzero(code & _MULTI).tolist()]
        for i, parts in multi:
            stops[i] = sum(t is None for t, _ in parts)
        return found, code, stops, multi

    def openings(self, texts: list[str | None]) -> Counter:
        """Capitalised words at the start of a passage, with what they are followed by left out."""
        found, code, stops, _ = self._tokens(texts)
        begins = np.concatenate([[True], stops[:-1] > 0]) if len(found) else np.zeros(0, bool)
        at = np.flatnonzero(begins & (stops == 0) & (code & _PLAIN > 0)).tolist()
        return Counter(w for w in (found[i] for i in at) if w[0].isupper() and (len(w) == 1 or not w.isupper()) and _CAPITAL.fullmatch(w))

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(text, passage, id, count)``, ordered, one row a distinct term of a passage; passages are numbered in each text."""
        found, code, stops, multi = self._tokens(texts)
        n = len(code)
        plain = np.zeros(n, bool)
        plain[1:] = (code[:-1] & _PLAIN) > 0
        where = np.arange(n)
        last = np.zeros(n, np.int64)
        last[1:] = np.maximum.accumulate(np.where(stops > 0, where, -1))[:-1]
        last[:1] = -1
        opens = ((code & _OPENS) > 0) & plain & (where - last > 2)
        text = np.cumsum((code & _ENDS) > 0)
        passage = np.cumsum(stops) - stops + np.cumsum(opens)
        # Passages before each text: those up to its mark, the mark's own stop included.
        first = np.zeros(len(texts), np.int64)
        first[1:] = passage[np.flatnonzero(code & _ENDS)] + 1
        ids = code & _ID
        ids[code & _MULTI > 0] = _ID
        self._spell(found, code, ids, stops, opens, plain)
        keep = ids != _ID
        rows = [(text[keep], passage[keep], ids[keep])]
        if multi:
            at, step, more = [], [], []
            for i, parts in multi:
                k = 0
                for term, _ in parts:
                    if term is None:
                        k += 1
                    else:
                        at.append(i)
                        step.append(k)
                        more.append(self.id_of(term))
            rows.append((text[at], passage[at] + np.array(step, np.int64), np.array(more, np.int64)))
        text, passage, ids = (np.concatenate(x) for x in zip(*rows))
        # One sortable number for (passage, id): ids are below 2**40.
        order = np.argsort((passage << 40) | ids, kind="stable") if n < 1 << 22 else np.lexsort((ids, passage))
        text, passage, ids = text[order], passage[order], ids[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (passage[1:] != passage[:-1])
        at = np.flatnonzero(new)
        return text[at], passage[at] - first[text[at]], ids[at], np.diff(np.append(at, len(ids)))

    def _spell(self, found, code, ids, stops, opens, plain) -> None:
        """Runs of at least four single letters become one term, at the place of the first."""
        single = (code & (_SINGLE | _MULTI)) == _SINGLE
        goes_on = np.zeros(len(code), bool)
        goes_on[1:] = single[1:] & single[:-1] & plain[1:] & (stops[:-1] == 0) & ~opens[1:]
        starts = np.flatnonzero(single & ~goes_on)
        if not len(starts):
            return
        ends = np.searchsorted(np.flatnonzero(~goes_on), starts, side="right")
        border = np.append(np.flatnonzero(~goes_on), len(code))
        for a, b in zip(starts.tolist(), border[ends].tolist()):
            if b - a >= 4:
                ids[a] = self.id_of("".join(_parts(found[i])[0][0] for i in range(a, b)))
                ids[a + 1 : b] = _ID


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the runs that begin at ``starts``, one after the other."""
    edge = np.concatenate([[0], np.cumsum(sizes)])
    return np.arange(edge[-1]) + np.repeat(starts - edge[:-1], sizes)


def _marks(rows: Vectors) -> np.ndarray:
    """64-bit fingerprints of the rows that are not empty, 0 for the others."""
    out = np.zeros(len(rows), np.uint64)
    x = rows.ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ rows.weights.view(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    full = np.diff(rows.starts) > 0
    if len(x):
        out[full] = np.add.reduceat(x ^ (x >> np.uint64(31)), rows.starts[:-1][full])
    return out


class Vectors:
    """Sparse rows: ``ids`` and ``weights`` of row i at ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, starts: np.ndarray, ids: np.ndarray, weights: np.ndarray):
        self.starts, self.ids, self.weights = starts, ids, weights

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Vectors:
        sizes = self.starts[rows + 1] - self.starts[rows]
        at = _expand(self.starts[rows], sizes)
        return Vectors(np.concatenate([[0], np.cumsum(sizes)]), self.ids[at], self.weights[at])


class BlockMaxIndex:
    """Exact cosine search over unit vectors by an inverted index with block maxima on two levels.

    Rows are ordered so that those sharing their telling terms lie together.  A query's
    bound for a group of ``BLOCK`` blocks of ``BLOCK`` rows comes from a table of term
    maxima, for a block of a group that passes from the posting lists; only rows of blocks
    that pass are computed.
    """

    BLOCK = 16
    #: Cells of the tables of a batch of queries.
    CELLS = 1 << 22

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]] | Vectors, width: int):
        if not isinstance(rows, Vectors):
            sizes = [len(r[0]) for r in rows]
            flat = [np.concatenate([np.asarray(r[k]) for r in rows]) if rows else np.zeros(0) for k in (0, 1)]
            rows = Vectors(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), flat[0].astype(np.int64), flat[1].astype(np.float64))
        self.n = len(rows)
        # Only terms of the index take part.
        self.terms = np.unique(rows.ids)
        self.local = np.full(width, -1, np.int64)
        self.local[self.terms] = np.arange(len(self.terms))
        self.order = self._clusters(rows)
        self.rows = rows.take(self.order)
        self.cols = self.local[self.rows.ids]
        self.blocks, self.groups = -(-self.n // self.BLOCK), -(-self.n // self.BLOCK**2)
        block = np.repeat(np.arange(self.n), np.diff(self.rows.starts)) // self.BLOCK
        key = self.cols * self.blocks + block
        order = np.argsort(key, kind="stable")
        key, vals = key[order], self.rows.weights[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(new)
        #: Posting lists: (term, block) as one number, and the largest weight in the block.
        self.postings = key[at]
        self.most = np.maximum.reduceat(vals, at) if len(at) else np.zeros(0)
        self.table = np.zeros((len(self.terms), self.groups), np.float32)
        np.maximum.at(self.table, (self.postings // max(self.blocks, 1), self.postings % max(self.blocks, 1) // self.BLOCK), self.most * (1 + 1e-6))

    def _clusters(self, rows: Vectors) -> np.ndarray:
        """Order of the rows by the three terms that weigh most in the row and are shared by many."""
        row = np.repeat(np.arange(self.n), np.diff(rows.starts))
        col = self.local[rows.ids]
        telling = rows.weights * np.log(np.bincount(col, minlength=len(self.terms)))[col]
        order = np.lexsort((-telling, row))
        keys = []
        for k in range(3):
            place = rows.starts[:-1] + k
            some = place < rows.starts[1:]
            keys.append(np.full(self.n, -1, np.int64))
            keys[k][some] = col[order[place[some]]]
        return np.lexsort(keys[::-1])

    def near(self, queries: Vectors, radius: float, k: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, row, cosine)`` of all rows with a cosine of at least ``radius`` > 0; with ``k``, of at least the k nearest of them and their ties."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        # Batches of queries whose tables stay small.
        most = max(1, self.CELLS // max(len(self.terms), self.groups, 1))
        entries = max(1, self.CELLS // max(self.groups, 1))
        a, n = 0, len(queries) if self.n else 0
        while a < n:
            b = min(n, a + most, max(a + 1, int(np.searchsorted(queries.starts, queries.starts[a] + entries, side="right")) - 1))
            out.append(self._near(queries, a, b, radius, k))
            a = b
        return tuple(np.concatenate(x) for x in zip(*out))

    def _near(self, queries: Vectors, a: int, b: int, radius: float, k: int | None):
        lo, hi = queries.starts[a], queries.starts[b]
        q = np.repeat(np.arange(b - a), np.diff(queries.starts[a : b + 1]))
        col, w = self.local[queries.ids[lo:hi]], queries.weights[lo:hi]
        # No cosine passes the norm of the terms that the index knows at all.
        known = (col >= 0) & (np.bincount(q, np.where(col >= 0, w * w, 0.0), b - a)[q] >= (radius - 1e-9) ** 2)
        q, col, w = q[known], col[known], w[known]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if not len(q):
            return out[0]
        first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
        size = np.diff(np.append(first, len(q)))
        bound = np.add.reduceat(self.table[col] * w[:, None].astype(np.float32), first, axis=0)
        some, group = np.nonzero(bound >= radius - 1e-5)
        if not len(some):
            return out[0]
        bound = bound[some, group]
        # Only queries that get so far, numbered anew, with a dense row each.
        met, some = np.unique(some, return_inverse=True)
        at = _expand(first[met], size[met])
        owner = np.repeat(np.arange(len(met)), size[met])
        col, w, asked = col[at], w[at], q[first[met]]
        size = size[met]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        dense = np.zeros((len(met), len(self.terms)))
        dense[owner, col] = w
        least = np.full(len(met), radius)
        # Groups of a query from the highest bound on: what the first give raises the bar for the others.
        order = np.lexsort((-bound, some))
        some, group, bound = some[order], group[order], bound[order]
        turn = np.arange(len(some)) - np.searchsorted(some, some)
        for low, high in ((0, 1), (1, 4), (4, self.groups)) if k else ((0, self.groups),):
            now = (turn >= low) & (turn < high) & (bound >= least[some] - 1e-5)
            found = self._rows(some[now], group[now], first, size, col, w, dense, least)
            out.append((asked[found[0]] + a, self.order[found[1]], found[2]))
            if k and high < self.groups:
                fq, sims = np.concatenate([x[0] for x in out]) - a, np.concatenate([x[2] for x in out])
                order = np.lexsort((-sims, fq))
                fq, sims = fq[order], sims[order]
                last = np.searchsorted(fq, asked) + k - 1
                full = last < len(fq)
                full[full] = fq[last[full]] == asked[full]
                least[full] = np.maximum(radius, sims[last[full]])
        return tuple(np.concatenate(x) for x in zip(*out))

    def _rows(self, some, group, first, size, col, w, dense, least):
        """``(query, row, cosine)`` within the pairs of query and group, where the cosine reaches the query's ``least``."""
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for c in range(0, len(some), 8192):
            s, g = some[c : c + 8192], group[c : c + 8192]
            at = _expand(first[s], size[s])
            pair = np.repeat(np.arange(len(s)), size[s])
            begin = np.searchsorted(self.postings, col[at] * self.blocks + g[pair] * self.BLOCK)
            count = np.searchsorted(self.postings, col[at] * self.blocks + np.minimum((g[pair] + 1) * self.BLOCK, self.blocks)) - begin
            post = _expand(begin, count)
            cell = np.repeat(pair, count) * self.BLOCK + self.postings[post] % self.blocks % self.BLOCK
            tight = np.bincount(cell, np.repeat(w[at], count) * self.most[post], len(s) * self.BLOCK)
            hit = np.flatnonzero(tight >= np.repeat(least[s], self.BLOCK) - 1e-9)
            hq, hb = s[hit // self.BLOCK], g[hit // self.BLOCK] * self.BLOCK + hit % self.BLOCK
            for k in range(0, len(hq), 4096):
                sq, sb = hq[k : k + 4096], hb[k : k + 4096]
                height = np.minimum((sb + 1) * self.BLOCK, self.n) - sb * self.BLOCK
                rows, rq = _expand(sb * self.BLOCK, height), np.repeat(sq, height)
                sizes = self.rows.starts[rows + 1] - self.rows.starts[rows]
                full = sizes > 0
                rows, rq, sizes = rows[full], rq[full], sizes[full]
                at = _expand(self.rows.starts[rows], sizes)
                sims = np.add.reduceat(dense[np.repeat(rq, sizes), self.cols[at]] * self.rows.weights[at], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                good = sims >= least[rq] - 1e-12
                out.append((rq[good], rows[good], sims[good]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def search(self, ids: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest rows (fewer if fewer share a term) and their cosines, nearest first."""
        _, at, sims = self.near(Vectors(np.array([0, len(ids)]), np.asarray(ids, np.int64), np.asarray(weights, np.float64)), 1e-9, k + (skip >= 0))
        at, sims = at[at != skip], sims[at != skip]
        keep = np.lexsort((at, -sims))[:k]
        return at[keep], sims[keep]


class Examples:
    """Fitted examples: vocabulary with weights, index, share of unwanted votes and label of each, probability of a vote."""

    def __init__(self, ids: dict[str, int], openers: frozenset[str], df: np.ndarray, n_docs: int, rows: pd.DataFrame):
        """``rows``: text, passage, id, count (one a term of a passage), with the text's doc_id, share and label."""
        self.ids, self.openers = ids, openers
        # Exact for every term in at least RARE of the documents; all rarer ones weigh alike.
        self.idf = np.log1p(n_docs / np.maximum(np.maximum(df, RARE * n_docs), 1.0)) if n_docs else np.ones(len(ids))
        self.unknown = float(np.log1p(1 / max(RARE, 1 / max(n_docs, 1))))
        self.keys: list[tuple] = []
        place: dict[tuple, int] = {}
        members: list[dict[int, tuple[float, str]]] = []
        used: list[tuple[int, int]] = []
        for (doc, _), g in _grouped(rows):
            key = tuple(zip(g["id"], g["count"]))
            i = place.setdefault(key, len(place))
            if i == len(members):
                members.append({})
                self.keys.append(key)
            members[i][doc] = (g["share"], g["label"])
            used.append((doc, i))
        sizes = np.array([len(k) for k in self.keys], np.int64)
        flat = np.array([x for k in self.keys for x in k], np.int64).reshape(-1, 2)
        self.vectors = self.weigh(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), flat[:, 0], flat[:, 1])
        self.number = np.array([len(m) for m in members], float)
        self.labels = [next((x for x, _ in Counter(x for _, x in m.values()).most_common() if x != CLEAN), CLEAN) for m in members]
        self.evidence = [min((d for d, (s, _) in m.items() if s > 0), default=min(m)) for m in members]
        # Pairs of a document and an example it holds, in order; what the document is rated, and how far the example is to blame for it.
        pairs = sorted(set(used))
        self.rated = np.array([members[i][doc][0] for doc, i in pairs], float)
        self.blame = self.rated
        doc, self.row = np.array(pairs, np.int64).reshape(-1, 2).T
        self.doc = np.unique(doc, return_inverse=True)[1]
        self._share()
        suspects = np.flatnonzero(self.rated > 0)
        if len(suspects):
            whole = BlockMaxIndex(self.vectors, len(ids))
            found = list(self._neighbours(lambda v, k: whole.near(v, RADIUS, k), suspects, np.zeros(len(members), np.int64)))
            for _ in range(2):
                self._settle(suspects, found)
        self.split()
        self._calibrate()
        del self.keys, self.blame, self.rated, self.doc, self.row

    def _share(self) -> None:
        self.share = np.bincount(self.row, self.blame, len(self.number)) / np.maximum(self.number, 1)

    def weigh(self, starts: np.ndarray, ids: np.ndarray, counts: np.ndarray, unknown: np.ndarray | None = None) -> Vectors:
        """Unit TF-IDF vectors; ``unknown``: what unknown terms add to the squared norm of each row."""
        w = self.idf[ids] * (1 + np.log(np.maximum(counts, 1))) if len(ids) else np.zeros(0)
        total = np.zeros(len(starts) - 1) if unknown is None else unknown * self.unknown**2
        row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        norm = np.sqrt(np.bincount(row, w * w, len(starts) - 1) + total)
        return Vectors(starts, ids, w / norm[row])

    def split(self) -> None:
        """Two indexes: unwanted examples, which every passage is compared with, and clean ones, for those with an unwanted neighbour."""
        bad = self.share > 0
        self.rows_bad, self.rows_good = np.flatnonzero(bad), np.flatnonzero(~bad)
        self.index_bad, self.index_good = (BlockMaxIndex(self.vectors.take(r), len(self.ids)) for r in (self.rows_bad, self.rows_good))

    @staticmethod
    def _ties(q: np.ndarray, sims: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order by query, nearest first, and where in it each run of equally near ones begins; cosines closer than ``TIE`` are equal."""
        order = np.lexsort((row, -sims, q))
        q, sims = q[order], sims[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (sims[:-1] - sims[1:] > TIE)
        return order, np.flatnonzero(new)

    @classmethod
    def _nearest(cls, q: np.ndarray, sims: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the NEAREST of each query and the part of a vote each has: equally near ones share the last places."""
        order, run = cls._ties(q, sims, row)
        size = np.diff(np.append(run, len(order)))
        before = run - np.searchsorted(q[order], q[order][run], side="left")
        part = np.repeat(np.clip((NEAREST - before) / size, 0.0, 1.0), size)
        return order[part > 0], part[part > 0]

    def _neighbours(self, find: Callable[[Vectors, int], tuple], pairs: np.ndarray, kind: np.ndarray) -> Iterator[tuple]:
        """The NEAREST of each pair's example as if the pair's document were unlabelled, in chunks: pair, neighbour, its weight,
        the documents left that hold it, the document's own pair with it (-1 for none).

        Passages of a document are no witnesses of each other, however many they are.  ``find`` gives at least the k nearest
        of each of two kinds of examples; where too few of other documents are among them, more are asked for.
        """
        keys = self.doc * len(self.number) + self.row
        for a in range(0, len(pairs), 4000):
            todo, k = pairs[a : a + 4000], NEAREST + 1
            while len(todo):
                asked, place = np.unique(self.row[todo], return_inverse=True)
                q, row, sims = find(self.vectors.take(asked), k)
                order = np.argsort(q, kind="stable")
                begin = np.searchsorted(q[order], np.arange(len(asked) + 1))
                size = np.diff(begin)[place]
                at, pair = order[_expand(begin[:-1][place], size)], np.repeat(np.arange(len(todo)), size)
                row, sims = row[at], sims[at]
                key = self.doc[todo][pair] * len(self.number) + row
                own = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                own[keys[own] != key] = -1
                left = self.number[row] - (own >= 0)
                keep, cell = left > 0, 2 * pair + kind[row]
                met, kept = (np.bincount(c, minlength=2 * len(todo)).reshape(-1, 2) for c in (cell, cell[keep]))
                short = ((met >= k) & (kept < NEAREST)).any(axis=1)
                keep &= ~short[pair]
                pair, row, sims, left, own = (x[keep] for x in (pair, row, sims, left, own))
                at, part = self._nearest(pair, sims, row)
                pair, row, sims, left, own = (x[at] for x in (pair, row, sims, left, own))
                yield todo[pair], row, part * sims**SHARPNESS * (1 + np.log(left)), left, own
                todo, k = todo[short], 4 * k

    def _votes(self, found: Iterable[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Weights of the neighbours of each pair, and weights of unwanted."""
        weight, bad = np.zeros(len(self.row)), np.zeros(len(self.row))
        total = np.bincount(self.row, self.blame, len(self.number))
        for pair, row, w, left, own in found:
            share = (total[row] - np.where(own >= 0, self.blame[own], 0.0)) / left
            weight += np.bincount(pair, w, len(weight))
            bad += np.bincount(pair, w * share, len(bad))
        return weight, bad

    def _settle(self, suspects: np.ndarray, found: list[tuple]) -> None:
        """Examples of unwanted documents vote on each other, each without its own document's votes."""
        weight, bad = (x[suspects] for x in self._votes(found))
        belief = (bad + UNSEEN * NO_VOTE) / (weight + NO_VOTE)
        top = np.zeros(self.doc.max() + 1)
        np.maximum.at(top, self.doc[suspects], belief)
        clean = np.bincount(self.row, self.rated == 0, len(self.number))[self.row[suspects]] > 0
        likeliest = (belief >= UNSEEN / 2) & (belief >= top[self.doc[suspects]] - TIE) & ~clean
        self.blame = np.zeros(len(self.row))
        guilty = suspects[(bad / (weight + NO_VOTE) >= 0.5) | likeliest]
        self.blame[guilty] = self.rated[guilty]
        self._share()

    def _calibrate(self) -> None:
        """Logistic map from a document's highest vote, without its own, to the share of unwanted documents."""
        weight, bad = self._votes(self._neighbours(self.near, np.arange(len(self.row)), (self.share > 0).astype(np.int64)))
        docs = int(self.doc.max()) + 1 if len(self.doc) else 0
        votes, hits = np.zeros(docs), np.zeros(docs)
        np.maximum.at(votes, self.doc, bad / (weight + NO_VOTE))
        np.maximum.at(hits, self.doc, self.rated)
        self.slope, self.shift = logistic(votes, hits)
        self.held_out = (votes, hits)

    def near(self, queries: Vectors, k: int = NEAREST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours of the queries that have an unwanted one, at least the k nearest of either kind: ``(query, example, cosine)``."""
        q, row, sims = self.index_bad.near(queries, RADIUS, k)
        some = np.unique(q)
        gq, grow, gsims = self.index_good.near(queries.take(some), RADIUS, k)
        return np.concatenate([q, some[gq]]), np.concatenate([self.rows_bad[row], self.rows_good[grow]]), np.concatenate([sims, gsims])

    def score(self, queries: Vectors) -> tuple[np.ndarray, np.ndarray]:
        """Vote for each query in [0, 1), and its nearest unwanted example (-1 if none is near)."""
        # Equal passages are looked up once; empty ones not at all.
        full = np.flatnonzero(np.diff(queries.starts))
        _, some, same = np.unique(_marks(queries)[full], return_index=True, return_inverse=True)
        votes, nearest = self._score(queries.take(full[some]))
        out, near = np.zeros(len(queries)), np.full(len(queries), -1, np.int64)
        out[full], near[full] = votes[same], nearest[same]
        return out, near

    def _score(self, queries: Vectors) -> tuple[np.ndarray, np.ndarray]:
        q, row, sims = self.near(queries)
        at, part = self._nearest(q, sims, row)
        w = part * sims[at] ** SHARPNESS * (1 + np.log(self.number[row[at]]))
        weight, bad = np.bincount(q[at], w, len(queries)), np.bincount(q[at], w * self.share[row[at]], len(queries))
        nearest = np.full(len(queries), -1, np.int64)
        hit = self.share[row] > 0
        q, row, sims = q[hit], row[hit], sims[hit]
        # The first of those equally near.
        order, run = self._ties(q, sims, row)
        best = np.minimum.reduceat(row[order], run) if len(run) else row
        nearest[q[order][run][::-1]] = best[::-1]
        return bad / (weight + NO_VOTE), nearest

    def probability(self, votes: np.ndarray) -> np.ndarray:
        return np.where(votes > 0, 1 / (1 + np.exp(-(self.slope * votes + self.shift))), 0.0) if len(self.rows_bad) else np.zeros(len(votes))


def _grouped(rows: pd.DataFrame) -> Iterator[tuple[tuple, dict]]:
    """Passages of the sorted rows: ((doc_id, passage), ids, counts, share and label)."""
    cols = {c: rows[c].tolist() for c in ("doc_id", "passage", "id", "count", "share", "label")}
    a, n = 0, len(rows)
    for b in range(1, n + 1):
        if b == n or cols["doc_id"][b] != cols["doc_id"][a] or cols["passage"][b] != cols["passage"][a]:
            yield (cols["doc_id"][a], cols["passage"][a]), {"id": cols["id"][a:b], "count": cols["count"][a:b], "share": cols["share"][a], "label": cols["label"][a]}
            a = b


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic map, by Newton's method with a slight pull of the slope to 0."""
    a, b = 0.0, 0.0
    for _ in range(60 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([(x * (p - y)).sum() + ridge * a, (p - y).sum()])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -5, 5)), b - float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-9:
            break
    return a, b


def reliability(examples: Examples, bins: int = 5) -> list[tuple[float, float, int]]:
    """Mean probability, share of unwanted and number of the labelled documents by probability, each scored without its own vote."""
    votes, hits = examples.held_out
    p = examples.probability(votes)
    at = np.minimum((p * bins).astype(int), bins - 1)
    return [(float(p[at == b].mean()), float(hits[at == b].mean()), int((at == b).sum())) for b in range(bins) if (at == b).any()]


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Bounded sample of labelled documents: id, share of unwanted ratings, commonest unwanted label, text."""
    rated = (
        labels.where("label is not null and doc_id is not null").groupBy("doc_id")
        .agg(F.avg((F.col("label") != CLEAN).cast("double")).alias("share"), F.coalesce(F.max(F.when(F.col("label") != CLEAN, F.col("label"))), F.lit(CLEAN)).alias("label"))
    )
    sample = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").where("text is not null")


_READ = "doc_id bigint, size array<int>, id array<int>, count array<int>, rest array<double>"


def _read(ids: dict[str, int], openers: frozenset[str]):
    """Each text's known terms, how many each passage has, and what unknown ones add to its norms; at the end of a
    task, one row without doc_id: documents by term in ``id`` and ``count``, the number of documents in ``size``."""
    width = len(ids)

    def lists(values: np.ndarray, owner: np.ndarray, n: int, kind) -> pa.ListArray:
        edges = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
        return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values.astype(kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(ids, openers)
        df, n_docs = np.zeros(width, np.int64), 0
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                docs, texts = batch.column(0).slice(a, 2000), batch.column(1).slice(a, 2000).to_pylist()
                text, passage, code, count = reader.read(texts)
                known = code < width
                n_docs += len(texts)
                df += np.bincount(np.unique(text[known] * width + code[known]) % width, minlength=width) if width else 0
                # Squared weights of unknown terms, in units of their common idf, by passage number.
                tf = (1 + np.log(count)) ** 2
                slots = np.zeros(len(texts), np.int64)
                np.maximum.at(slots, text, passage + 1)
                edges = np.concatenate([[0], np.cumsum(slots)])
                rest = np.bincount(edges[text[~known]] + passage[~known], tf[~known], edges[-1]).astype(np.float64)
                sizes = np.bincount(edges[text[known]] + passage[known], minlength=edges[-1]).astype(np.int32)
                slots = pa.array(edges.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [docs, pa.ListArray.from_arrays(slots, pa.array(sizes)), lists(code[known], text[known], len(texts), np.int32), lists(count[known], text[known], len(texts), np.int32),
                     pa.ListArray.from_arrays(slots, pa.array(rest))],
                    names=["doc_id", "size", "id", "count", "rest"],
                )
        at = np.flatnonzero(df)
        one = lambda v, kind: pa.array([v], pa.list_(kind))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), one([n_docs], pa.int32()), one(at.tolist(), pa.int32()), one(df[at].tolist(), pa.int32()), one([], pa.float64())],
            names=["doc_id", "size", "id", "count", "rest"],
        )

    return run


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Examples, DataFrame]:
    """Examples from at most ``MAX_LABELLED`` labelled documents, term statistics from all ``docs``; and all texts as read."""
    spark = docs.sparkSession
    tmp = Scratch(spark, "abuse")
    labelled = tmp.put(_labelled(docs, labels), "labelled")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, openings = Reader({}, frozenset(), grows=True), Counter()
        for pdf in batches:
            reader.read(pdf["text"].tolist())
            openings.update(reader.openings(pdf["text"][pdf["share"] == 0].tolist()))
        yield pd.DataFrame([(w, n, True) for w, n in openings.items()] + [(w, 0, False) for w in reader.ids], columns=["word", "n", "opens"])

    # Words of a bounded number of documents.
    found = labelled.mapInPandas(words, "word string, n bigint, opens boolean").groupBy("word", "opens").agg(F.sum("n").alias("n")).collect()
    total = sum(r.n for r in found if r.opens)
    openers = frozenset(r.word for r in found if r.opens and r.n >= max(3, total / 2000))
    ids = {w: i for i, w in enumerate(sorted(r.word for r in found if not r.opens))}
    read = tmp.put(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null").mapInArrow(_read(ids, openers), _READ), "read")
    tails = read.where("doc_id is null")
    df = np.zeros(len(ids), np.int64)
    # One row a term of the bounded vocabulary, whatever the number of documents.
    for r in tails.select(F.explode(F.arrays_zip("id", "count")).alias("x")).groupBy("x.id").agg(F.sum("x.count").alias("n")).collect():
        df[r.id] = r.n
    n_docs = tails.agg(F.sum(F.col("size")[0])).first()[0] or 0
    sample = labelled.select("doc_id", "share", "label").dropDuplicates(["doc_id"])
    rows = read.where("doc_id is not null").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).toPandas().sort_values("doc_id")
    sizes = rows["id"].map(len).to_numpy(np.int64) if len(rows) else np.zeros(0, np.int64)
    flat = {c: np.concatenate(rows[c].tolist()).astype(np.int64) if len(rows) else np.zeros(0, np.int64) for c in ("size", "id", "count")}
    slots = flat.pop("size")
    slot = np.repeat(np.arange(len(slots)), slots)
    flat["passage"] = slot  # numbered over all documents, which keeps passages of two documents apart
    table = pd.DataFrame({**flat, **{c: np.repeat(rows[c].to_numpy(), sizes) for c in ("doc_id", "share", "label")}})
    return Examples(ids, openers, df, n_docs, table), read.where("doc_id is not null")


def score_documents(docs: DataFrame, labels: DataFrame, evidence: bool = True) -> DataFrame:
    """``(doc_id, score, label, passage, example_doc_id)`` for every row of ``docs`` (doc_id, text) with an id.

    ``score`` in [0, 1] is the fitted probability for the likeliest passage, ``passage`` its
    text (left out unless ``evidence``), ``label`` and ``example_doc_id`` those of its nearest
    unwanted example.  Null, empty and blank texts score 0 without evidence.  Without usable
    labels all score 0, as do texts without an unwanted neighbour.  Ratings with a null label are ignored, disagreeing raters share the
    vote, repeated rows are each scored; other columns are ignored.  Whole texts are read.
    """
    spark = docs.sparkSession
    fitted, read = fit(docs, labels)
    examples = spark.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ex = examples.value
        for batch in batches:
            for a in range(0, batch.num_rows, 4000):
                part = batch.slice(a, 4000)
                n = part.num_rows
                flat = lambda c: (np.asarray(part.column(c).flatten()), np.diff(np.asarray(part.column(c).offsets)))
                (sizes, slots), (ids, _), (counts, _), (rest, _) = (flat(c) for c in ("size", "id", "count", "rest"))
                edges = np.concatenate([[0], np.cumsum(slots)])
                # One query a passage, those without a known term included.
                starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                votes, nearest = ex.score(ex.weigh(starts, ids.astype(np.int64), counts, rest))
                doc = np.repeat(np.arange(n), slots)
                order = np.lexsort((-np.arange(len(votes)), votes, doc))
                best = np.full(n, -1, np.int64)
                best[doc[order]] = order
                some = best >= 0
                vote, near, number = np.zeros(n), np.full(n, -1, np.int64), np.full(n, -1, np.int64)
                vote[some], near[some], number[some] = votes[best[some]], nearest[best[some]], best[some] - edges[:-1][some]
                score = np.where(some, ex.probability(vote), 0.0)
                shown = near >= 0
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score), pa.array([ex.labels[i] if i >= 0 else None for i in near.tolist()], pa.string()),
                     pa.array(np.where(shown, number, -1).astype(np.int32)), pa.array([ex.evidence[i] if i >= 0 else None for i in near.tolist()], pa.int64())],
                    names=["doc_id", "score", "label", "number", "example_doc_id"],
                )

    scored = read.mapInArrow(run, "doc_id bigint, score double, label string, number int, example_doc_id bigint")
    if not evidence:
        return scored.drop("number")
    kept = Scratch(spark, "scored").put(scored, "scored")
    openers = fitted.openers

    def shown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["passage"] = [text[slice(*_spans(text, openers)[n])].strip() for text, n in zip(pdf.pop("text"), pdf.pop("number"))]
            yield pdf

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    near = kept.where("number >= 0").distinct().join(texts, "doc_id")
    cols = ["doc_id", "score", "label", "passage", "example_doc_id"]
    cut = near.mapInPandas(shown, "doc_id bigint, score double, label string, example_doc_id bigint, passage string")
    return kept.where("number < 0").withColumn("passage", F.lit(None).cast("string")).select(cols).unionByName(cut.select(cols))


def source_rates(docs: DataFrame, scores: DataFrame) -> DataFrame:
    """``(source, documents, cases, rate)`` per source, null sources together."""
    joined = docs.select("doc_id", "source").join(scores.select("doc_id", "score"), "doc_id")
    return joined.groupBy("source").agg(
        F.count("*").alias("documents"), F.count_if(F.col("score") >= THRESHOLD).alias("cases"),
        F.round(F.avg((F.col("score") >= THRESHOLD).cast("double")), 6).alias("rate"),
    )
