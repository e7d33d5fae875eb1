"""Flattening of many JSON texts at once, by a structural index over their bytes in numpy.

What ``jsontree.flatten`` gives for a text's tree, here without trees: quotes tell what is inside strings, brackets give
each token its depth and parent, and paths, cases, keys and places are worked out depth by depth for all texts together.
Values are cut from the bytes, so numbers stay as they were written. Texts with an escape, a control character in a
string, a repeated key, deep nesting or any fault are left to the tree; they get the same result there.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from . import jsontree as jt

FIELD = pa.struct([("field", pa.string()), ("match_key", pa.string()), ("place", pa.int32()), ("value", pa.string()), ("case_id", pa.string())])

#: Bytes of texts that are indexed together, and the depth beyond which a text is left to the tree.
PIECE, MOST_DEPTH = 1 << 18, 40

_SPACE, _OBJECT, _ARRAY, _END_OBJECT, _END_ARRAY, _COLON, _COMMA, _TEXT, _SCALAR, _NOTHING = range(10)
_KINDS = np.full(256, _SCALAR, np.uint8)
_KINDS[list(b" \t\n\r")] = _SPACE
_KINDS[list(b'{[}]:,"')] = [_OBJECT, _ARRAY, _END_OBJECT, _END_ARRAY, _COLON, _COMMA, _TEXT]
_LEXEME = r"^(-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null|NaN|-?Infinity)$"


def lists_of(ends: list[int] | np.ndarray, columns: list, kind: pa.StructType) -> pa.ListArray:
    """Arrow lists of structs from the structs' columns and where each list ends."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.StructArray.from_arrays(arrays, fields=list(kind)))


def flatten_texts(texts: pa.Array, keys: Mapping[str, str]) -> pa.ListArray:
    """The fields of each text, none for a null, blank or malformed one."""
    found = [_flatten_piece(piece, keys) for piece in _pieces(texts if texts.type == pa.string() else texts.cast(pa.string()))]
    return pa.concat_arrays(found) if found else lists_of([], [[]] * 5, FIELD)


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts without nulls, and where each begins, with the end."""
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[starts[0] : starts[-1]], starts - starts[0]


def _flatten_piece(texts: pa.Array, keys: Mapping[str, str]) -> pa.ListArray:
    plain = np.zeros(len(texts), bool)
    given = np.flatnonzero(texts.is_valid().to_numpy(zero_copy_only=False))
    if len(given):
        own = texts if len(given) == len(texts) else texts.take(pa.array(given))
        data, starts = _bytes_of(own)
        counts = [np.diff(np.searchsorted(np.flatnonzero(data == mark), starts)) for mark in b'\\"']
        even = (counts[0] == 0) & (counts[1] % 2 == 0)
        if not even.all():
            given, own = given[even], own.filter(pa.array(even))
        if len(given):
            good, fields = _Index(*_bytes_of(own), keys).fields()
            plain[given] = good
    if plain.all() and len(plain):
        return fields
    columns: tuple[list, ...] = ([], [], [], [], [])
    ends = []
    rest = np.flatnonzero(~plain)
    for text in texts.take(pa.array(rest)).to_pylist():
        try:
            if text is not None and text.strip():
                jt.flatten_into(columns, jt.parse(text), keys)
        except ValueError:
            pass
        ends.append(len(columns[0]))
    slow = lists_of(ends, list(columns), FIELD)
    if not plain.any():
        return slow
    place = np.empty(len(plain), np.int64)
    place[plain], place[rest] = np.arange(plain.sum()), plain.sum() + np.arange(len(rest))
    return pa.concat_arrays([fields, slow]).take(pa.array(place))


def _shifted(values: np.ndarray, first: np.ndarray, fill: int) -> np.ndarray:
    """Each token's predecessor's value; ``fill`` for the first of a text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first] = fill
    return out


class _Index:
    """The tokens of texts that have no escape: kind, place in the bytes, text, parent token, and more by depth."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, keys: Mapping[str, str]):
        self.keys, self.n = keys, len(starts) - 1
        kinds = _KINDS[data]
        inside = (np.cumsum(kinds == _TEXT, dtype=np.uint8) & 1).view(bool)
        outside = ~inside
        scalar = (kinds == _SCALAR) & outside
        begins = scalar.copy()
        begins[1:] &= ~scalar[:-1]
        is_token = begins | (outside & (kinds >= _OBJECT) & (kinds <= _COMMA)) | (inside & (kinds == _TEXT))
        at = np.flatnonzero(is_token)
        kind, per_text = kinds[at], np.diff(np.searchsorted(at, starts))
        self.good = (per_text > 0) & (np.diff(np.searchsorted(np.flatnonzero(inside & (data < 32)), starts)) == 0)

        depth = np.cumsum(np.where(kind <= _ARRAY, 1, np.where(kind <= _END_ARRAY, -1, 0)))
        text = np.repeat(np.arange(self.n), per_text)
        first = np.cumsum(per_text) - per_text
        before = np.concatenate([[0], depth])[first]
        depth -= before[text]
        inner = depth + np.where(kind <= _ARRAY, -1, np.where(kind <= _END_ARRAY, 1, 0))
        is_first = np.zeros(len(at) + 1, bool)
        is_first[first[per_text > 0]] = True
        is_first = is_first[:-1]
        wrong = np.where(is_first, kind != _OBJECT, inner < 1) | (inner > MOST_DEPTH)
        self._drop(text[wrong])
        ends = first[per_text > 0] + per_text[per_text > 0] - 1
        self._drop(text[ends[depth[ends] != 0]])

        kept = self.good[text]
        if not kept.all():
            at, kind, text, inner, is_first = at[kept], kind[kept], text[kept], inner[kept], is_first[kept]
        space = outside & (kinds == _SPACE)
        if space.any():  # without it, a container's bytes are its compact JSON, and a scalar ends where the next token begins
            at = at - np.cumsum(space)[at]
            data = data[~space]
        self.data, self.at, self.kind, self.text, self.inner, self.first = data, at, kind, text, inner, np.flatnonzero(is_first)
        self.next_at = np.append(at[1:], 0)
        self._parents()
        self._grammar()
        self._names()

    def _drop(self, texts: np.ndarray) -> None:
        self.good[texts] = False

    def _parents(self) -> None:
        kind, inner = self.kind, self.inner
        self.depths = int(inner.max()) if len(inner) else 0
        self.parent, self.close = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
        opens = kind <= _ARRAY
        for depth in range(1, self.depths + 1):
            above, own = np.flatnonzero(opens & (inner == depth - 1)), np.flatnonzero(inner == depth)
            self.parent[own] = above[np.searchsorted(above, own) - 1]
        closes = np.flatnonzero((kind == _END_OBJECT) | (kind == _END_ARRAY))
        self.close[self.parent[closes]] = closes

    def _grammar(self) -> None:
        kind, before = self.kind, _shifted(self.kind, self.first, _NOTHING)
        in_object = self.kind[self.parent] == _OBJECT
        self.in_object = in_object
        starts = (kind <= _ARRAY) | (kind >= _TEXT)
        ended = ((before >= _END_OBJECT) & (before <= _END_ARRAY)) | (before == _TEXT) | (before == _SCALAR)
        self.is_key = (kind == _TEXT) & in_object & ((before == _OBJECT) | (before == _COMMA))
        after_key = _shifted(self.is_key, self.first, False)
        self.is_value = starts & ~self.is_key
        placed = np.where(in_object, before == _COLON, (before == _ARRAY) | (before == _COMMA))
        placed[self.first] = True
        wrong = self.is_value & ~placed
        wrong |= (kind == _COLON) & ~(in_object & after_key)
        wrong |= (kind == _COMMA) & (~ended | after_key)
        wrong |= (kind == _END_OBJECT) & ~(in_object & ((before == _OBJECT) | (ended & ~after_key)))
        wrong |= (kind == _END_ARRAY) & (in_object | ~((before == _ARRAY) | ended))
        self._drop(self.text[wrong])
        scalars = np.flatnonzero(kind == _SCALAR)
        lexemes = self.cut(scalars)
        self._drop(self.text[scalars[~pc.match_substring_regex(lexemes, _LEXEME).to_numpy(zero_copy_only=False)]])
        self.is_null = np.zeros(len(kind), bool)
        self.is_null[scalars] = pc.equal(lexemes, "null").to_numpy(zero_copy_only=False)

    def _names(self) -> None:
        """Numbers of the keys, each value's own, and the places of values by parent and key."""
        tokens = np.flatnonzero(self.is_key)
        coded = self.cut(tokens).dictionary_encode()
        self.names = coded.dictionary.to_pylist()
        self.number = {name: i for i, name in enumerate(self.names)}
        self.name = np.full(len(self.kind) + 2, -1, np.int64)
        self.name[tokens + 2] = coded.indices.to_numpy()
        self.name = self.name[:-2]
        codes = self.parent[tokens] * max(1, len(self.names)) + self.name_at(tokens)
        order = np.argsort(codes, kind="stable")
        self.codes, self.coded = codes[order], tokens[order] + 2
        twice = self.codes[1:] == self.codes[:-1]
        self._drop(self.text[tokens[order][1:][twice]])

    def name_at(self, tokens: np.ndarray) -> np.ndarray:
        """The key numbers of key tokens; a text that ends after its key is wrong already and has none."""
        return self.name[np.minimum(tokens + 2, len(self.name) - 1)]

    def cut(self, tokens: np.ndarray, whole: bool = False) -> pa.StringArray:
        """The bytes of tokens: of strings what is between the quotes, unless ``whole``; of containers their JSON."""
        kind, begin = self.kind[tokens], self.at[tokens]
        end = np.where(kind <= _ARRAY, self.at[self.close[tokens]] + 1, self.next_at[tokens])
        if not whole:
            begin, end = begin + (kind == _TEXT), end - (kind == _TEXT)
        sizes = np.maximum(0, end - begin)
        offsets = np.zeros(len(tokens) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        index = np.repeat(begin - offsets[:-1], sizes) + np.arange(offsets[-1])
        return pa.StringArray.from_buffers(len(tokens), pa.py_buffer(offsets), pa.py_buffer(self.data[index]))

    def _first_of(self, at: np.ndarray) -> np.ndarray:
        """The first item of arrays, -1 of an empty one; others as they are."""
        array = (at >= 0) & (self.kind[at] == _ARRAY)
        return np.where(array, np.where(self.kind[np.minimum(at + 1, len(self.kind) - 1)] == _END_ARRAY, -1, at + 1), at)

    def _child(self, at: np.ndarray, name: str) -> np.ndarray:
        """The values of a key in objects, -1 where there is none."""
        if name not in self.number or not len(self.codes):
            return np.full(len(at), -1)
        code = at * len(self.names) + self.number[name]
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((at >= 0) & (self.kind[at] == _OBJECT) & (self.codes[place] == code), self.coded[place], -1)

    def match_keys(self, items: np.ndarray, spec: str) -> pa.StringArray:
        """``jsontree.match_key`` of each item; what Python does to a text, it does once for equal ones."""
        parts = []
        for path in jt.key_paths(spec):
            at = items
            for name in path:
                at = self._child(self._first_of(at), name)
            at = self._first_of(at)
            there = (at >= 0) & ~self.is_null[at]
            found = at[there]
            container = self.kind[found] <= _ARRAY
            coded = pc.if_else(pa.array(container), "c", "t")
            coded = pc.binary_join_element_wise(coded, self.cut(found), "").dictionary_encode()
            texts = [x[1:].lower() if x[0] == "c" else jt.without_space(x[1:]).lower() for x in coded.dictionary.to_pylist()]
            place = np.full(len(items), len(texts), np.int64)
            place[there] = coded.indices.to_numpy()
            parts.append(pa.array([*texts, "null"]).take(pa.array(place)))
        return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, "-")

    def fields(self) -> tuple[np.ndarray, pa.ListArray]:
        """Which texts are indexed without fault, and their fields."""
        kind, parent, n = self.kind, self.parent, len(self.kind)
        case_name = self.number.get(jt.SOURCE_CASE, -2)
        is_case = self.is_value & (self.name == case_name)
        self._drop(self.text[is_case & (kind <= _ARRAY)])
        is_value = self.is_value & self.good[self.text]
        leaf = is_value & (kind >= _TEXT) & ~is_case
        own_case = np.full(n, -1, np.int64)
        told = np.flatnonzero(is_case & (kind >= _TEXT) & ~self.is_null)
        own_case[parent[told]] = told

        paths, path_number = [""], {"": 0}
        path, case, key = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, np.int64)
        keyed, item = np.zeros(n, bool), np.zeros(n, bool)
        key_texts, known = [pa.array([None], pa.string())], 1
        for depth in range(self.depths + 1):
            nodes = np.flatnonzero(is_value & (self.inner == depth))
            above = parent[nodes]
            if depth:
                path[nodes], case[nodes], key[nodes], item[nodes] = path[above], case[above], key[above], keyed[above]
                self._step(nodes[self.in_object[nodes]], path, paths, path_number)
            case[nodes] = np.where(own_case[nodes] >= 0, own_case[nodes], case[nodes])
            in_keys = np.array([p in self.keys for p in paths])[path[nodes]]
            if not in_keys.any():
                continue
            some = nodes[in_keys]
            specs = np.array([bool(self.keys.get(p)) for p in paths])
            keyed[some] = (kind[some] == _ARRAY) & ~item[some] & specs[path[some]]
            with_key = some[item[some] | ((kind[some] == _OBJECT) & (path[some] > 0))]
            for number in np.unique(path[with_key]):
                mine = with_key[path[with_key] == number]
                own = self.match_keys(mine, self.keys[paths[number]])
                outer = key[mine]
                if outer.any():
                    behind = pa.concat_arrays(key_texts).take(pa.array(outer))
                    own = pc.coalesce(pc.binary_join_element_wise(behind, own, "-"), own)
                key_texts.append(own)
                key[mine] = np.arange(known, known + len(mine))
                known += len(mine)

        leaves = np.flatnonzero(leaf)
        visited = self._visited(leaf, keyed)
        if visited is not None:
            leaves = leaves[np.argsort(visited[leaves], kind="stable")]
        value = self.cut(leaves)
        null = self.is_null[leaves]
        if null.any():
            value = pc.if_else(pa.array(null), pa.scalar(None, pa.string()), value)
        told = np.unique(case[leaves])
        cases = pc.if_else(pa.array(told < 0), pa.scalar(None, pa.string()), self.cut(np.maximum(told, 0))) if len(told) else pa.array([], pa.string())
        columns = [
            pa.array(paths, pa.string()).take(pa.array(path[leaves])),
            pa.concat_arrays(key_texts).take(pa.array(key[leaves])),
            pa.array(_places(self.text[leaves] * len(paths) + path[leaves]), pa.int32()),
            value,
            cases.take(pa.array(np.searchsorted(told, case[leaves]))),
        ]
        ends = np.cumsum(np.bincount(self.text[leaves], minlength=self.n)[self.good])
        return self.good, lists_of(ends, columns, FIELD)

    def _step(self, nodes: np.ndarray, path: np.ndarray, paths: list[str], path_number: dict[str, int]) -> None:
        """Values of objects go one key further than their object's path."""
        codes, distinct = pd.factorize(path[nodes] * max(1, len(self.names)) + self.name[nodes])
        numbers = []
        for code in distinct.tolist():
            above, name = paths[code // len(self.names)], self.names[code % len(self.names)]
            own = f"{above}.{name}" if above else name
            if own not in path_number:
                path_number[own] = len(paths)
                paths.append(own)
            numbers.append(path_number[own])
        path[nodes] = np.array(numbers, np.int64)[codes] if numbers else 0

    def _visited(self, leaf: np.ndarray, keyed: np.ndarray) -> np.ndarray | None:
        """The order of tokens with the items of arrays without keys ordered by their JSON; None if it is theirs already."""
        before = np.cumsum(leaf) - leaf
        items = np.flatnonzero(self.is_value & ~self.in_object & ~keyed[self.parent] & (self.inner > 0) & self.good[self.text])
        many = np.bincount(self.parent[items], minlength=1)[self.parent[items]] > 1
        items = items[many]
        if not len(items):
            return None
        above = self.parent[items]
        order = pc.sort_indices(pa.table({"a": above, "b": self.cut(items, True).cast(pa.binary())}), [("a", "ascending"), ("b", "ascending")]).to_numpy()
        items, above = items[order], above[order]
        last = np.where(self.kind[items] <= _ARRAY, self.close[items], items)
        sizes = before[last] + leaf[last] - before[items]
        passed = np.cumsum(sizes) - sizes
        group = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
        within = passed - np.repeat(passed[group], np.diff(np.append(group, len(above))))
        moved = np.zeros(len(leaf), np.int64)
        moved[items] = within - (before[items] - before[above])
        for depth in range(1, self.depths + 1):
            nodes = np.flatnonzero(self.is_value & (self.inner == depth))
            moved[nodes] += moved[self.parent[nodes]]
        return before + moved


def _places(codes: np.ndarray) -> np.ndarray:
    """Each value's number among the equal ones before it."""
    order = np.argsort(codes, kind="stable")
    ordered = codes[order]
    group = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(codes) else np.zeros(0, np.int64)
    out = np.empty(len(codes), np.int64)
    out[order] = np.arange(len(codes)) - np.repeat(group, np.diff(np.append(group, len(codes))))
    return out
