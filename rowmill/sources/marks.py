"""Where records begin and end in a byte range, for each state it may be entered in.

A range of a file cannot know whether it begins inside a quoted cell, a string or a comment.
It is therefore looked at once for each such state. What it says then is small, so the true
states of all ranges follow from one walk over them in order, and the rows are read from
every range by itself.

Borders are moved past bytes that would leave more states than that: past quotes and
carriage returns in delimited files, past backslashes in JSON.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np

from rowmill.sources.store import Bytes

#: Bytes that a border is moved past, by kind of file.
HOLD = {"delimited": b'"\r', "lines": b"\r", "array": b"\\", "xml": b""}
STEP = 1 << 16
NEWLINE = re.compile(rb"\r\n?|\n")
BOM = b"\xef\xbb\xbf"

_REST_OF_QUOTED = re.compile(rb'[^"]*+(?:""[^"]*+)*+("?)')


@lru_cache
def _quoted_cell(sep: bytes) -> re.Pattern:
    return re.compile(rb'(?<![^\r\n' + re.escape(sep) + rb'])"[^"]*+(?:""[^"]*+)*+("?)')


# ---------------------------------------------------------------- delimited


def quoted_spans(data: bytes, at: int, inside: bool, sep: bytes) -> tuple[list[tuple[int, int]], bool]:
    """Stretches inside quotes from ``at`` on, and whether the last is open at the end. A
    quote opens a cell only where the cell begins."""
    out, still = [], False
    if inside:
        first = _REST_OF_QUOTED.match(data, at)
        out.append((at, first.end()))
        at, still = first.end(), not first[1]
    for m in _quoted_cell(sep).finditer(data, at):
        out.append(m.span())
        still = not m[1]
    return out, still


def first_break(data: bytes, at: int, spans: list[tuple[int, int]]) -> int:
    """The place after the first line break from ``at`` on that is not in quotes; -1 if none."""
    begins = [s for s, _ in spans]
    while m := NEWLINE.search(data, at):
        inside = bisect_right(begins, m.start()) - 1
        if inside < 0 or m.start() >= spans[inside][1]:
            return m.end()
        at = spans[inside][1]
    return -1


def delimited_state(data: bytes, lead: int, inside: bool, sep: bytes) -> dict:
    """Whether the range ends inside quotes, and whether a cell in it holds a line break."""
    if data.find(b'"', lead) < 0:
        return {"inside": inside, "breaks": inside and data.find(b"\n", lead) >= 0}
    spans, still = quoted_spans(data, lead, inside, sep)
    return {"inside": still, "breaks": any(data.find(b"\n", s, e) >= 0 for s, e in spans)}


def delimited_text(source: Bytes, start: int, end: int, inside: bool, sep: bytes | None, body: int) -> bytes:
    """The whole records that begin in a range, from ``body`` on, which begins one. Without
    ``sep`` quotes mean nothing."""
    hold = HOLD["delimited" if sep else "lines"]
    a, b = source.settle(start, hold), source.settle(end, hold)
    if body >= b:
        return b""
    at_once = a <= body
    if at_once:
        a, inside = body, False
    lead = 1 if a else 0
    data = source.read(a - lead, b)
    spans, still = quoted_spans(data, lead, inside, sep) if sep else ([], False)
    first = lead if at_once or (not inside and data[:lead] == b"\n") else first_break(data, lead, spans)
    if first < 0 or first >= len(data):
        return b""
    tail, size = b"", STEP
    while b < source.size and (still or not data.endswith(b"\n")):
        upto = source.settle(b + size, hold)
        more = source.read(b - 1, upto)
        cut = first_break(more, 1, quoted_spans(more, 1, still, sep)[0] if sep else [])
        if cut >= 0 or upto >= source.size:
            tail = more[1 : cut if cut >= 0 else None]
            break
        size *= 4
    return data[first:] + tail


# ---------------------------------------------------------------- JSON arrays

_STEPS = np.zeros(256, np.int8)
_STEPS[[ord("["), ord("{")]] = 1
_STEPS[[ord("]"), ord("}")]] = -1
_MARKS = _STEPS != 0
_MARKS[ord(",")] = True


def json_marks(data: bytes, at: int, inside: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of brackets and commas outside strings, their steps of depth, and whether a
    string is open at the end."""
    values = np.frombuffer(data, np.uint8)[at:]
    quotes = np.flatnonzero(values == 34)
    escaped = []
    for i in np.flatnonzero((quotes > 0) & (values[quotes - 1] == 92)).tolist():
        q = int(quotes[i]) + at
        k = q - 1
        while k >= at and data[k] == 92:
            k -= 1
        if (q - 1 - k) % 2:
            escaped.append(i)
    quotes = np.delete(quotes, escaped)
    marks = np.flatnonzero(_MARKS[values])
    marks = marks[(np.searchsorted(quotes, marks) + inside) % 2 == 0]
    return marks + at, _STEPS[values[marks]].astype(np.int64), bool((len(quotes) + inside) % 2)


def array_state(data: bytes, inside: bool) -> dict:
    """Change of depth, the least depth, how often it is met, whether it is met at the last
    mark, and whether a string is open at the end."""
    _, steps, still = json_marks(data, 0, inside)
    depth = np.cumsum(steps)
    low = int(depth.min()) if len(depth) else 0
    return {
        "inside": still,
        "marks": len(depth),
        "change": int(depth[-1]) if len(depth) else 0,
        "low": low,
        "lows": int((depth == low).sum()),
    }


def _bounds(data: bytes, at: int, inside: bool, depth: int) -> tuple[list[int], list[bool], int, bool]:
    """Places where elements of the array are parted, whether each is its end, the depth
    after all marks and whether a string is open."""
    marks, steps, still = json_marks(data, at, inside)
    after = depth + np.cumsum(steps)
    closes = (steps < 0) & (after == 0)
    parts = ((steps >= 0) & (after == 1)) | closes
    return marks[parts].tolist(), closes[parts].tolist(), int(after[-1]) if len(after) else depth, still


def array_elements(source: Bytes, start: int, end: int, inside: bool, depth: int) -> Iterator[bytes]:
    """Texts of the elements of a whole-file array that begin in a range."""
    hold = HOLD["array"]
    a, b = source.settle(start, hold), source.settle(end, hold)
    data = source.read(a, b)
    bounds, closes, depth, still = _bounds(data, 0, inside, depth)
    for i, (p, closed) in enumerate(zip(bounds, closes)):
        if closed:
            return
        last = i + 1 == len(bounds)
        if not last:
            text = data[p + 1 : bounds[i + 1]].strip()
        else:
            tail, size = b"", STEP
            while b < source.size:
                upto = source.settle(b + size, hold)
                tail = source.read(b, upto)
                next_, *_ = _bounds(tail, 0, still, depth)
                if next_ or upto >= source.size:
                    tail = tail[: next_[0] if next_ else None]
                    break
                size *= 4
            text = (data[p + 1 :] + tail).strip()
        opening = data[p : p + 1] != b","
        if text or not opening or (not last and not closes[i + 1]):
            yield text


# ---------------------------------------------------------------- XML

#: What a range may begin in beside plain text and tags, and the bytes that end it.
ASIDE = {"comment": b"-->", "cdata": b"]]>", "instruction": b"?>"}
_TOKEN = re.compile(
    rb"<(?:(!--).*?(?:-->|\Z)|(!\[CDATA\[).*?(?:\]\]>|\Z)|(\?).*?(?:\?>|\Z)|(!DOCTYPE)[^>\[]*(?:\[.*?\]\s*)?>"
    rb"|(/?)([^\s<>/!?\"'=][^\s<>/\"'=]*)((?:[^<>\"']++|\"[^<\"]*+\"|'[^<']*+')*+)>)",
    re.DOTALL,
)
_KINDS = {1: "comment", 2: "cdata", 3: "instruction", 4: "doctype"}
#: A tag alone, or an element without children as a whole: the name of a tag that closes, that
#: of one that opens, the rest of that, and the mark of a close that follows at once.
_PLAIN = re.compile(
    rb"<(?:/([^\s<>/!?\"'=][^\s<>/\"'=]*)(?:[^<>\"']++|\"[^<\"]*+\"|'[^<']*+')*+>"
    rb"|([^\s<>/!?\"'=][^\s<>/\"'=]*)((?:[^<>\"']++|\"[^<\"]*+\"|'[^<']*+')*+)>(?:(?<!/>)[^<]*+(</)\2\s*+>)?)"
)
_NO_TAG = re.compile(rb"<[!?]")
PLAIN_BYTES = 1 << 18


@lru_cache
def _tags_of(tag: str) -> re.Pattern:
    """Where tags of a name begin, or what is no tag."""
    return re.compile(rb"<(?=[!?]|/?" + re.escape(tag.encode()) + rb"[\s/>\"'=])")


def xml_tokens(
    source: Bytes,
    start: int,
    end: int,
    state: str,
    take: Callable[[int, int, str, str], object],
    only: str | None = None,
    plain: Callable[[bytes, int, int], int] | None = None,
) -> tuple[str, bool]:
    """What a range ends in, and whether anything in it is no markup. ``state`` is what it
    begins in, or text.

    ``take`` gets the tags whose first byte is in the range: from, to, name, kind, with places
    in the file; kinds are open, close and single. With ``only`` it gets those of that name, in
    files that are known to be all markup. ``plain`` may take some tags before: it gets data,
    a place and the range's length, and returns the place up to which it took all.
    """
    begins = _tags_of(only) if only and "\ufffd" not in only else None
    # enough bytes to tell all openings apart
    data = source.read(start, end + 9 + (len(only.encode()) if only else 0))
    length = end - start
    at = 0
    if state != "text":
        mark = ASIDE[state]
        look = min(len(mark) - 1, start)
        whole = source.read(start - look, end)
        found = whole.find(mark)
        if found < 0:
            return state, False
        at = found + len(mark) - look
    size, bad = STEP, False
    at = plain(data, at, length) if plain else at
    while True:
        if begins:
            next_ = begins.search(data, at)
            at_ = next_.start() if next_ else -1
        else:
            at_ = data.find(b"<", at)
        if at_ < 0 or at_ >= length:
            return "text", bad
        m = _TOKEN.match(data, at_)
        if m is None or (m.end() == len(data) and not m[6] and start + len(data) < source.size):
            # cut off by the end of the piece, or no markup at all
            aside = next((k for k, o in (("comment", b"<!--"), ("cdata", b"<![CDATA["), ("instruction", b"<?")) if data.startswith(o, at_)), None)
            if aside:
                return aside, bad
            more = start + len(data) < source.size
            second = data.find(b"<", at_ + 1)
            if not more or (0 <= second and not data.startswith(b"<!DOCTYPE", at_)):
                bad = True
                at = at_ + 1
                continue
            data += source.read(start + len(data), start + len(data) + size)
            size *= 4
            continue
        at = m.end()
        if m[6]:
            name = m[6].decode("utf-8", "replace")
            take(start + m.start(), start + m.end(), name, "close" if m[5] else "single" if m[7].endswith(b"/") else "open")
            continue
        if m.end() > length and m.lastindex != 4:
            return _KINDS[m.lastindex], bad
        if m.lastindex != 4 and not m[0].endswith(ASIDE[_KINDS[m.lastindex]]):
            return _KINDS[m.lastindex], bad
        at = plain(data, at, length) if plain else at


def xml_state(source: Bytes, start: int, end: int, state: str) -> dict:
    """What a range closes that was open before it, what it leaves open, and how many
    elements it begins, by depth and name."""
    closes: list[str] = []
    opens: list[str] = []
    counts: dict[tuple[int, str], int] = {}
    texts: dict[bytes, str] = {}
    crossed = False

    def close(name: str) -> None:
        nonlocal crossed
        if opens:
            crossed |= opens.pop() != name
        else:
            closes.append(name)

    def take(_: int, __: int, name: str, kind: str) -> None:
        if kind == "close":
            return close(name)
        key = (len(opens) - len(closes), name)
        counts[key] = counts.get(key, 0) + 1
        if kind == "open":
            opens.append(name)

    def text(name: bytes) -> str:
        if name not in texts:
            texts[name] = name.decode("utf-8", "replace")
        return texts[name]

    def plain(data: bytes, at: int, length: int) -> int:
        """Tags up to the next that is none, or the last one, which may be cut."""
        while (upto := data.rfind(b"<", at, min(at + PLAIN_BYTES, length))) > at:
            aside = _NO_TAG.search(data, at, upto)
            upto = aside.start() if aside else upto
            found = _PLAIN.findall(data, at, upto)
            if data.count(b"<", at, upto) != len(found) + sum(1 for t in found if t[3]):
                return at
            for closed, opened, rest, whole in found:
                if closed:
                    close(text(closed))
                    continue
                name = text(opened)
                key = (len(opens) - len(closes), name)
                counts[key] = counts.get(key, 0) + 1
                if not whole and not rest.endswith(b"/"):
                    opens.append(name)
            at = upto
            if aside:
                break
        return at

    after, bad = xml_tokens(source, start, end, state, take, plain=plain)
    bad |= crossed
    return {"state": after, "bad": bad, "closes": closes, "opens": opens, "counts": [[*k, n] for k, n in counts.items()]}


def xml_elements(source: Bytes, start: int, end: int, state: str, open_: list[str], tag: str) -> Iterator[bytes]:
    """Texts of the outermost elements of a name that begin in a range."""
    depth, begin, size = open_.count(tag), None, STEP
    own_end = end
    while start < own_end or (begin is not None and start < source.size):
        tokens: list[tuple[int, int, str, str]] = []
        data = source.read(start, end)
        state, _ = xml_tokens(source, start, end, state, lambda *t: tokens.append(t), tag)

        def text(a: int, b: int) -> bytes:
            return data[a - start : b - start] if start <= a and b <= end else source.read(a, b)

        for a, b, name, kind in tokens:
            if name != tag or (begin is None and a >= own_end):
                continue
            if kind == "single":
                if depth == 0:
                    yield text(a, b)
            elif kind == "open":
                if depth == 0:
                    begin = a
                depth += 1
            elif depth:
                depth -= 1
                if depth == 0 and begin is not None:
                    yield text(begin, b)
                    begin = None
        start, end = end, min(end + size, source.size)
        size *= 4
