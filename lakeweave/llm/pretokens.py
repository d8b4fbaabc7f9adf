"""Cutting texts into pre-tokens with numpy, as the byte-level BPE tokenizers' pattern does, and reading their files."""

from __future__ import annotations

import functools
import json

import numpy as np
import regex

from .words import chunks, hash_spans, padded

#: The pattern that is cut by (fixed value). ``cut`` follows it by rule, on bytes; see there.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts are handled in slices of at most so many bytes (a longer text alone).
SLICE_BYTES = 28 << 20
#: ... and cut in pieces of at most so many.
_CUT_BYTES = 2 << 20
SPACE, LETTER, NUMBER, OTHER = range(4)


def added_tokens(path: str) -> list[str]:
    """Texts that the tokenizer takes as one token wherever they stand, longest first.

    Raises ValueError for tokenizers whose texts can't be cut by PATTERN beforehand.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    way = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or way.get("type") != "ByteLevel" or way.get("add_prefix_space") or not way.get("use_regex", True):
        raise ValueError("only byte-level tokenizers without normaliser and prefix space are counted by pre-token")
    found = spec.get("added_tokens") or []
    if any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in found):
        raise ValueError("added tokens with rules of their own for white space or words aren't counted by pre-token")
    return sorted((x["content"] for x in found), key=len, reverse=True)


@functools.cache
def _classes() -> np.ndarray:
    """The class of each code point."""
    points = "".join(map(chr, (x for x in range(0x110000) if not 0xD800 <= x < 0xE000)))
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, points):
            a, b = ord(points[m.start()]), ord(points[m.end() - 1]) + 1
            out[a:b] = kind
    return out


def _byte_classes(d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte's character, and whether a character begins there."""
    table = _classes()
    kind = table[d]
    first = np.ones(len(d), bool)
    if len(d) and d.max() >= 0x80:
        first = (d & 0xC0) != 0x80
        lead = np.flatnonzero(d >= 0xC0)
        padded = np.concatenate([d, np.zeros(3, np.uint8)]).astype(np.int64)
        b0, b1, b2, b3 = (padded[lead + i] for i in range(4))
        two = (b0 & 0x1F) << 6 | b1 & 0x3F
        three = (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F
        four = (b0 & 0x07) << 18 | (b1 & 0x3F) << 12 | (b2 & 0x3F) << 6 | b3 & 0x3F
        point = np.where(b0 < 0xE0, two, np.where(b0 < 0xF0, three, four))
        kind[lead] = table[np.minimum(point, 0x10FFFF)]
        for back in (1, 2, 3):  # the bytes that follow take their character's class
            at = lead + back
            at = at[at < len(d)]
            at = at[~first[at] & (d[at - back] >= np.array([0, 0xC0, 0xE0, 0xF0])[back])]
            kind[at] = kind[at - back]
    return kind, first


def cut(d: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Byte positions at which pre-tokens begin; ``edges``: where texts begin (sorted), none of which a pre-token spans.

    Runs of letters, of numbers and of other characters are pre-tokens, with a single blank before them. The white space
    before that blank, or all of it if the last isn't a blank but for its last character, is one; so is all white space
    at a text's end. An apostrophe alone takes one of the endings that PATTERN lists from the letters after it.
    """
    n = len(d)
    if not n:
        return np.zeros(0, np.int64)
    kind, first = _byte_classes(d)
    edge = np.zeros(n + 1, bool)
    edge[edges] = edge[0] = edge[n] = True
    run = edge[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(run)
    stops = np.append(starts[1:], n)
    space = kind[starts] == SPACE
    begin = np.zeros(n + 1, bool)
    begin[starts] = True
    # white space before something else: its last character stands apart
    mid = space & ~edge[stops]
    last = stops[mid] - 1
    for _ in range(3):
        last = last - ~first[last]
    begin[last] = True
    begin[stops[mid][d[last] == 0x20]] = False  # a blank goes with what follows
    # apostrophes
    alone = starts[(stops - starts == 1) & (d[starts] == 0x27) & begin[starts] & ~edge[stops]]
    if len(alone):
        after = np.concatenate([d, np.zeros(3, np.uint8)])
        one, two = after[alone + 1], after[alone + 2]
        long = (alone + 2 < n) & ~edge[np.minimum(alone + 2, n)] & (((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l"))))
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        took = np.where(short, 1, np.where(long, 2, 0))
        alone, took = alone[took > 0], took[took > 0]
        begin[alone + 1] = False
        begin[alone + 1 + took] = True
    return np.flatnonzero(begin[:n])


class Pretokens:
    """The pre-tokens of a slice of texts.

    ``row`` and ``which`` of each in order: its text, and its number among the distinct ones. ``texts``: the distinct ones' bytes;
    ``key``: their hashes, which texts may share.
    ``special``: how many added tokens each text holds; those are texts' borders and no pre-tokens.
    Pre-tokens count as equal if their bytes are; hashes only bring equal ones together.
    """

    def __init__(self, offsets: np.ndarray, d: np.ndarray, added: tuple[bytes, ...] = ()) -> None:
        o = (offsets - offsets[0]).astype(np.int64)
        rows = len(o) - 1
        self.special = np.zeros(rows, np.int64)
        edges = o[:-1][np.diff(o) > 0]
        taken: list[tuple[int, int]] = []
        if added and rows:
            found = regex.compile(b"|".join(regex.escape(x) for x in added))
            raw = d.tobytes()
            if any(x in raw for x in added):
                for i in range(rows):
                    taken += [m.span() for m in found.finditer(raw, int(o[i]), int(o[i + 1]))]
            if taken:
                spans = np.array(taken, np.int64)
                np.add.at(self.special, np.searchsorted(o, spans[:, 0], "right") - 1, 1)
                inner = spans[:, 1][spans[:, 1] < len(d)]
                edges = np.union1d(edges, np.concatenate([spans[:, 0], inner]))
        parts = []
        for a, b in chunks(o, _CUT_BYTES):
            lo, hi = np.searchsorted(edges, [o[a], o[b]])
            parts.append((cut(d[o[a] : o[b]], edges[lo:hi] - o[a]) + o[a]).astype(np.int32 if len(d) < 1 << 31 else np.int64))
        s = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        e = np.append(s[1:], len(d)).astype(s.dtype)
        if taken:
            inside = np.searchsorted(spans[:, 0], s, "right") - 1
            keep = (inside < 0) | (s >= spans[np.maximum(inside, 0), 1])
            s, e = s[keep], e[keep]
        self.row = (np.searchsorted(o, s, "right") - 1).astype(np.int32)
        raw = d.tobytes()
        own = padded(d)
        key = hash_spans(own, s, e)
        self.key, at, which = np.unique(key, return_index=True, return_inverse=True)
        others = _differing(own, s, e, at[which])
        if others:  # of another text than the first one with their hash: told apart by their bytes
            known: dict[bytes, int] = {}
            for i in others:
                text = raw[s[i] : e[i]]
                if text not in known:
                    known[text] = len(at) + len(known)
                which[i] = known[text]
            first = {w: i for i, w in zip(reversed(others), which[others[::-1]].tolist(), strict=True)}
            at = np.concatenate([at, [first[w] for w in known.values()]])
            self.key = np.concatenate([self.key, key[at[len(self.key) :]]])
        self.which = which.astype(np.int32)
        self.texts = [raw[a:b] for a, b in zip(s[at].tolist(), e[at].tolist(), strict=True)]


def _differing(d: np.ndarray, s: np.ndarray, e: np.ndarray, like: np.ndarray, step: int = 1 << 20) -> list[int]:
    """Numbers of the spans whose bytes aren't those of the span ``like`` says, which has the same hash, in order; some ``step``
    bytes at a time. Of one length up to eight bytes, ``hash_spans`` gives the same hash only to the same bytes."""
    s, e = s.astype(np.int64), e.astype(np.int64)
    n = e - s
    out: list[int] = np.flatnonzero(n != n[like]).tolist()
    todo = np.flatnonzero((n > 8) & (n == n[like]) & (like != np.arange(len(s))))
    size = n[todo]
    ends = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < len(todo):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + step, "right")) - 1)
        part, m = todo[i:j], size[i:j]
        if j == i + 1:
            a, b = int(part[0]), int(like[part[0]])
            if (d[s[a] : e[a]] != d[s[b] : e[b]]).any():
                out.append(a)
        else:
            place = np.arange(ends[j] - ends[i])
            start = ends[i:j] - ends[i]
            wrong = d[np.repeat(s[part] - start, m) + place] != d[np.repeat(s[like[part]] - start, m) + place]
            if wrong.any():
                out += part[np.unique(np.searchsorted(start, np.flatnonzero(wrong), "right") - 1)].tolist()
        i = j
    return sorted(out)
