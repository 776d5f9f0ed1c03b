"""Deeply nested JSON to flat, linked rows by vectorised structural indexing (problem 2).

A batch of documents is one byte array. Bitmaps of quotes, brackets and
delimiters give the string spans (prefix sums of unescaped quotes) and the
nesting depth (prefix sums of brackets); sorting the structural tokens by depth
links each value to the container it stands in. Members are then found by
comparing key bytes, spans are cut out, and rows are emitted with the place of
each entry. JSON text inside a JSON string is decoded and goes through the same
index again.

Results for odd input: a document that is null, blank or not valid JSON (cut
off, bad scalar, bad escape, control character in a string) gives no rows; of
repeated members the last counts; a null entry gives no row but keeps its
place; a single value where a list is usual counts as a list of one; an
extraction may be the document, its member ``extraction`` or the entries of its
member ``items``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flashmill.kernel import pieces

KEYS = ("items", "extraction", "events", "commodities", "summary", "dominant_types", "event_type")
EVENT_FIELDS = ("event_type_name", "direction", "direction_cn", "degree", "degree_cn", "trigger_word", "reversed", "reversal_word", "degree_word", "position")

_NUMBER = re.compile(rb"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?\Z")
_WORDS = {b"true", b"false", b"null"}
_IS_WS = np.isin(np.arange(256), [32, 9, 10, 13])
_IS_STRUCT = np.isin(np.arange(256), list(b"{}[],:"))
_ESCAPES = np.isin(np.arange(256), list(b'"\\/bfnrtu'))
_HEX = np.isin(np.arange(256), list(b"0123456789abcdefABCDEF"))
_OPEN, _CLOSE = np.isin(np.arange(256), list(b"{[")), np.isin(np.arange(256), list(b"}]"))
STRING, SCALAR = ord('"'), ord("0")


class Index:
    """Structural index of a batch of documents."""

    def __init__(self, docs: list[bytes]):
        n = len(docs)
        off = np.zeros(n + 1, np.int64)
        np.cumsum([len(d) + 1 for d in docs], out=off[1:])
        self.data = data = b"\n".join(docs) + b"\n"
        b = np.frombuffer(data, np.uint8)
        self.b = b
        ok = np.ones(n, bool)
        # unescaped quotes: an even number of backslashes before them
        bs = b == 92
        if bs.any():
            at = np.arange(len(b))
            last = np.maximum.accumulate(np.where(bs, -1, at))
            run = at - last  # backslashes that end here
            escaped = np.zeros(len(b), bool)
            escaped[1:] = (run[:-1] & 1) == 1
        else:
            escaped = np.zeros(len(b), bool)
        quote = (b == 34) & ~escaped
        count = np.cumsum(quote, dtype=np.int32)
        before = count - quote
        base = np.concatenate([[0], count[off[1:] - 1]])
        ok &= (np.diff(base) & 1) == 0
        doc_of = np.repeat(np.arange(n), np.diff(off))
        inside = (((before - base[doc_of]) & 1) == 1) & ~quote  # strictly between quotes
        # what a string may not hold
        wrong = inside & (b < 32)
        esc = np.flatnonzero(escaped)
        if len(esc):
            wrong[esc[~inside[esc]]] = True
            wrong[esc[~_ESCAPES[b[esc]]]] = True
            u = esc[b[esc] == 117]
            if len(u):
                four = np.minimum(u[:, None] + np.arange(1, 5), len(b) - 1)
                wrong[u[~_HEX[b[four]].all(1)]] = True
        stray = (b == 92) & ~inside
        ok[np.unique(doc_of[np.flatnonzero(wrong | stray)])] = False
        outside = ~inside & ~quote
        struct = outside & _IS_STRUCT[b]
        plain = outside & ~struct & ~_IS_WS[b]
        first = plain.copy()
        first[1:] &= ~plain[:-1]
        opening = quote & (((before - base[doc_of]) & 1) == 0)
        pos = np.flatnonzero(struct | first | opening)
        kind = np.where(struct[pos], b[pos], np.where(opening[pos], STRING, SCALAR)).astype(np.uint8)
        doc = doc_of[pos]
        # the end of each string and scalar
        qpos = np.flatnonzero(quote)
        end = pos + 1
        s = kind == STRING
        if s.any():
            j = np.searchsorted(qpos, pos[s], side="right")
            end[s] = qpos[np.minimum(j, len(qpos) - 1)] + 1
        s = kind == SCALAR
        if s.any():
            stop = np.flatnonzero(~plain)
            end[s] = stop[np.searchsorted(stop, pos[s])]
            for t in np.flatnonzero(s).tolist():
                x = data[pos[t] : end[t]]
                if x not in _WORDS and not _NUMBER.match(x):
                    ok[doc[t]] = False
        step = _OPEN[kind].astype(np.int64) - _CLOSE[kind]
        depth = np.cumsum(step)
        cuts = np.searchsorted(doc, np.arange(n + 1))
        run0 = np.concatenate([[0], depth])[cuts]
        depth -= run0[:-1][doc]
        full = cuts[1:] > cuts[:-1]
        ok &= full
        ok[np.flatnonzero(full)] &= depth[cuts[1:][full] - 1] == 0
        ok[np.unique(doc[depth < 0])] = False
        live = ok[doc]
        pos, kind, doc, end, depth, step = (x[live] for x in (pos, kind, doc, end, depth, step))
        m = len(pos)
        level = depth - (step > 0) + (step < 0) * 0
        level = np.where(step < 0, depth + 1, np.where(step > 0, depth - 1, depth))  # of closers: their container's inner level
        # parent: the last opener of the level above, by one stable sort over (document, level)
        opens = np.flatnonzero(step > 0)
        who = np.concatenate([np.arange(m), opens])
        lev = np.concatenate([level, depth[opens]])
        mark = np.concatenate([np.full(m, -1), opens])
        order = np.lexsort((mark >= 0, who, lev, doc[who]))
        # an opener's mark sorts before its content: content has greater token numbers on that level
        filled = np.maximum.accumulate(np.where(mark[order] >= 0, np.arange(len(order)), -1))
        parent = np.full(m, -1)
        sel = mark[order] < 0
        got = filled[sel]
        parent[who[order][sel]] = np.where(got >= 0, mark[order][np.maximum(got, 0)], -1)
        parent[level == 0] = -1
        self._grammar(ok, kind, doc, parent, step)
        live = ok[doc] if m else np.zeros(0, bool)
        self.ok, self.pos, self.end, self.kind, self.doc, self.parent, self.live = ok, pos, end, kind, doc, parent, live

    def _grammar(self, ok, kind, doc, parent, step) -> None:
        m = len(kind)
        if not m:
            return
        prev = np.concatenate([[0], kind[:-1]])
        prev[np.concatenate([[True], doc[1:] != doc[:-1]])] = 0
        box = np.where(parent >= 0, kind[np.maximum(parent, 0)], 0)
        obj, arr = box == ord("{"), box == ord("[")
        is_key = (kind == STRING) & obj & ((prev == ord("{")) | (prev == ord(",")))
        prev_key = np.concatenate([[False], is_key[:-1]])
        value = (kind == STRING) & ~is_key | (kind == SCALAR) | (step > 0)
        done = ((prev == STRING) & ~prev_key) | (prev == SCALAR) | (prev == ord("}")) | (prev == ord("]"))
        good = np.zeros(m, bool)
        good |= value & ((prev == 0) & (parent < 0) | arr & ((prev == ord("[")) | (prev == ord(","))) | obj & (prev == ord(":")))
        good |= is_key
        good |= (kind == ord(":")) & prev_key
        good |= (kind == ord(",")) & done & (parent >= 0)
        good |= (kind == ord("}")) & obj & (done | (prev == ord("{")))
        good |= (kind == ord("]")) & arr & (done | (prev == ord("[")))
        ok[np.unique(doc[~good])] = False
        self.is_key, self.is_value = is_key, value

    def link(self) -> None:
        """Place of each value in its list, and for each wanted key the member of each object."""
        m = len(self.pos)
        if not m:
            self.member, self.values = {}, np.zeros(0, np.int64)
            return
        val = np.flatnonzero(self.is_value & self.live)
        by = val[np.lexsort((val, self.parent[val]))]
        p = self.parent[by]
        first = np.concatenate([[True], p[1:] != p[:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
        self.place = np.zeros(m, np.int64)
        self.place[by] = np.arange(len(by)) - start
        self.values = val
        self.by_parent, self.by_parent_keys = by, p
        keys = np.flatnonzero(self.is_key & self.live)
        a, e = self.pos[keys] + 1, self.end[keys] - 1
        odd = {}
        for i in np.flatnonzero(np.isin(keys, self._with_escape(keys))).tolist():
            odd.setdefault(json.loads(self.data[a[i] - 1 : e[i] + 1]), []).append(i)
        self.member = {}
        for name in (*KEYS, *EVENT_FIELDS):
            raw = np.frombuffer(name.encode(), np.uint8)
            c = np.flatnonzero(e - a == len(raw))
            if len(c):
                c = c[(self.b[a[c][:, None] + np.arange(len(raw))] == raw).all(1)]
            if name in odd:
                c = np.unique(np.concatenate([c, odd[name]]).astype(np.int64))
            of = np.full(m, -1)
            k = keys[c]
            of[self.parent[k]] = k + 2  # key, colon, value; of repeated keys the last
            self.member[name] = of

    def _with_escape(self, keys: np.ndarray) -> np.ndarray:
        if 92 not in self.data[:0] and b"\\" not in self.data:
            return keys[:0]
        slash = np.flatnonzero(self.b == 92)
        return keys[np.searchsorted(slash, self.pos[keys]) < np.searchsorted(slash, self.end[keys])]

    def entries(self, container: int) -> np.ndarray:
        a, e = np.searchsorted(self.by_parent_keys, [container, container + 1])
        return self.by_parent[a:e]

    def text(self, t: int) -> str | None:
        """A value as text: strings decoded, null None, containers as JSON."""
        k = self.kind[t]
        if k == STRING:
            raw = self.data[self.pos[t] + 1 : self.end[t] - 1]
            return json.loads(b'"' + raw + b'"') if b"\\" in raw else raw.decode("utf-8", "replace")
        if k == SCALAR:
            raw = self.data[self.pos[t] : self.end[t]].decode()
            return None if raw == "null" else raw
        same = np.flatnonzero((self.parent == t) & _CLOSE[self.kind])
        return self.data[self.pos[t] : self.end[same[-1]]].decode("utf-8", "replace")


def _is_null(ix: Index, t: int) -> bool:
    return ix.kind[t] == SCALAR and ix.data[ix.pos[t] : ix.pos[t] + 4] == b"null"


def _json_text(ix: Index, t: int) -> str | None:
    """The decoded string if it looks like an object or a list written as text."""
    if ix.kind[t] != STRING:
        return None
    x = ix.text(t).strip()
    return x if x[:1] in ("{", "[") and x[-1:] in ("}", "]") else None


def extract(docs: list[bytes], fields: bool = False) -> Iterator[tuple]:
    """(document number, item_no, child, child_no, child_value, fields) of a batch of documents."""
    #: work: text, document number, item number (-1: not known yet), role, place, what to do if it isn't JSON
    work = [(x, i, -1, "root", 0, None) for i, x in enumerate(docs)]
    while work:  # each round's texts are shorter
        ix = Index([w[0] for w in work])
        ix.link()
        more: list[tuple] = []
        roots = ix.values[ix.parent[ix.values] == -1] if len(ix.values) else []
        got = {int(ix.doc[t]): int(t) for t in roots}
        for j, (text, i, item, role, place, plain) in enumerate(work):
            t = got.get(j)
            if t is None:
                if plain is not None:
                    yield plain
                continue
            yield from _walk(ix, t, i, item, role, place, more, fields)
        work = more


def _walk(ix: Index, t: int, i: int, item: int, role: str, place: int, more: list, fields: bool) -> Iterator[tuple]:
    k, mem = ix.kind[t], ix.member
    if _is_null(ix, t):
        return
    if role in ("root", "item"):
        if (x := _json_text(ix, t)) is not None:
            more.append((x.encode(), i, item, role, place, None))
        elif k == ord("["):
            if role == "root":
                for e in ix.entries(t).tolist():
                    yield from _walk(ix, e, i, int(ix.place[e]), "item", 0, more, fields)
        elif k == ord("{"):
            its, ext = int(mem["items"][t]), int(mem["extraction"][t])
            if role == "root" and its >= 0 and not _is_null(ix, its):
                if (x := _json_text(ix, its)) is not None:
                    more.append((x.encode(), i, -1, "items", 0, None))
                else:
                    yield from _walk(ix, its, i, -1, "items", 0, more, fields)
            elif ext >= 0:
                yield from _walk(ix, ext, i, max(item, 0), "item", 0, more, fields)
            else:
                for name, kind in (("events", "event"), ("commodities", "commodity")):
                    if (v := int(mem[name][t])) >= 0:
                        yield from _list(ix, v, i, max(item, 0), kind, more, fields)
                if (s := int(mem["summary"][t])) >= 0:
                    yield from _walk(ix, s, i, max(item, 0), "summary", 0, more, fields)
    elif role == "items":
        if k == ord("["):
            for e in ix.entries(t).tolist():
                yield from _walk(ix, e, i, int(ix.place[e]), "item", 0, more, fields)
        else:
            yield from _walk(ix, t, i, 0, "item", 0, more, fields)
    elif role == "summary":
        if (x := _json_text(ix, t)) is not None:
            more.append((x.encode(), i, item, role, place, None))
        elif k == ord("{") and (v := int(mem["dominant_types"][t])) >= 0:
            yield from _list(ix, v, i, item, "dominant_type", more, fields)
    elif role.startswith("list "):
        yield from _list(ix, t, i, item, role[5:], more, fields)
    else:
        yield from _entry(ix, t, i, item, role, place, more, fields)


def _list(ix: Index, v: int, i: int, item: int, kind: str, more: list, fields: bool) -> Iterator[tuple]:
    if _is_null(ix, v):
        return
    if (x := _json_text(ix, v)) is not None:
        more.append((x.encode(), i, item, "list " + kind, 0, _row(i, item, kind, 0, "" if kind == "event" else ix.text(v), None)))
    elif ix.kind[v] == ord("["):
        for e in ix.entries(v).tolist():
            if not _is_null(ix, e):
                yield from _entry(ix, e, i, item, kind, int(ix.place[e]), more, fields)
    else:
        yield from _entry(ix, v, i, item, kind, 0, more, fields)


def _row(i: int, item: int, kind: str, no: int, value: str | None, fields) -> tuple:
    return (i, item, kind, no, value or "", fields)


def _entry(ix: Index, e: int, i: int, item: int, kind: str, no: int, more: list, fields: bool) -> Iterator[tuple]:
    if kind != "event":
        yield _row(i, item, kind, no, ix.text(e), None)
    elif ix.kind[e] == ord("{"):
        t = int(ix.member["event_type"][e])
        own = None
        if fields:
            own = [ix.text(int(ix.member[f][e])) if ix.member[f][e] >= 0 else None for f in EVENT_FIELDS]
        yield _row(i, item, kind, no, ix.text(t) if t >= 0 else "", own)
    elif (x := _json_text(ix, e)) is not None:
        more.append((x.encode(), i, item, kind, no, _row(i, item, kind, no, "", None)))
    else:
        yield _row(i, item, kind, no, "", None)


def _run(batches: Iterator[pa.RecordBatch], fields: bool) -> Iterator[pa.RecordBatch]:
    names = ["extraction_id", "item_no", "child", "child_no", "child_value", *(EVENT_FIELDS if fields else ())]
    for batch in batches:
        for part in pieces(batch, 1):
            ids = part.column(0)
            docs = [b"" if x is None else x for x in part.column(1).cast(pa.binary()).to_pylist()]
            rows = list(extract(docs, fields))
            if fields:
                rows = [r for r in rows if r[2] == "event"]
            cols = list(zip(*rows)) if rows else [[]] * 6
            out = [
                ids.take(pa.array(cols[0], pa.int64())),
                pa.array(cols[1], pa.int64()),
                pa.array(cols[2], pa.string()),
                pa.array(cols[3], pa.int64()),
                pa.array(cols[4], pa.string()),
            ]
            if fields:
                out += [pa.array([None if r is None else r[f] for r in cols[5]], pa.string()) for f in range(len(EVENT_FIELDS))]
            yield pa.RecordBatch.from_arrays(out, names)


def _schema(df: DataFrame, id_col: str, fields: bool) -> str:
    kind = df.schema[id_col].dataType.simpleString()
    return f"extraction_id {kind}, item_no long, child string, child_no long, child_value string" + "".join(f", {f} string" for f in (EVENT_FIELDS if fields else ()))


def flatten_extractions(df: DataFrame, id_col: str, payload: str) -> DataFrame:
    """extraction_id, item_no, child (event, commodity, dominant_type), child_no, child_value: the linked flat rows."""
    src = df.select(F.col(id_col), F.col(payload))
    return src.mapInArrow(lambda it: _run(it, False), _schema(src, id_col, False))


def flatten_events(df: DataFrame, id_col: str, payload: str) -> DataFrame:
    """The events as a flat table: link columns and all fields as text; composite fields as JSON."""
    src = df.select(F.col(id_col), F.col(payload))
    out = src.mapInArrow(lambda it: _run(it, True), _schema(src, id_col, True))
    return out.drop("child").withColumnRenamed("child_no", "event_no").withColumnRenamed("child_value", "event_type")
