"""Merging the payloads of several cases into one record that knows where each field came from."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from .jsontree import CASE_BY_FIELD, SOURCE_CASE, canonical, content_text, dump, match_key, text_of


@dataclass(frozen=True)
class Policy:
    """How a segment's fields merge.

    arrays: paths of arrays whose items are united; item_keys: path -> key spec of their items; priority: path -> field
    whose presence lets an item win; atomic: path -> slots of objects that are taken whole but for these.
    """

    arrays: frozenset[str] = frozenset()
    item_keys: Mapping[str, str] = field(default_factory=dict)
    priority: Mapping[str, str] = field(default_factory=dict)
    atomic: Mapping[str, tuple[str, ...]] = field(default_factory=dict)


@dataclass(frozen=True)
class Version:
    """A payload and the time it counts for; ``at`` compares as text, the later one wins."""

    tree: dict
    at: str | None


def _content(node: Any) -> str:
    return content_text(node)


def _alike(a: Any, b: Any) -> bool:
    """Whether two trees are the same but for the order of keys; a number is not the string of its digits."""
    kind = type(a)
    if kind is not type(b):
        return False
    if kind is dict:
        return len(a) == len(b) and all(k in b and _alike(x, b[k]) for k, x in a.items())
    if kind is list:
        return len(a) == len(b) and all(map(_alike, a, b))
    return a == b


def _older_first(a: Version, b: Version) -> tuple[Version, Version]:
    """(loser, winner): the later time wins, a known one over none, the greater canonical text on a tie."""
    if a.at != b.at:
        return (b, a) if b.at is None or (a.at is not None and a.at > b.at) else (a, b)
    if a.at is None:
        return a, b
    own = [{k: v for k, v in x.tree.items() if k != CASE_BY_FIELD} for x in (a, b)]
    if _alike(*own):  # a replay, whose texts need not be written
        return b, a
    text = [dump(canonical(x)) for x in own]
    return (b, a) if text[0] >= text[1] else (a, b)


def merge(a: Version, b: Version, policy: Policy) -> Version:
    """One version of two; the result's time is the later one."""
    loser, winner = _older_first(a, b)
    first, second = (a.tree, b.tree)
    tree = _objects(first, second, winner is a, policy, "")
    times = [x.at for x in (a, b) if x.at is not None]
    return Version(tree, max(times) if times else None)


def merge_all(versions: list[Version], policy: Policy) -> Version:
    return reduce(lambda x, y: merge(x, y, policy), versions)


def shape_of(tree: dict, policy: Policy) -> dict[str, str] | None:
    """The kind of value at each path that a merge looks at; None where an array has two items of one key.

    Versions whose shapes agree on their common paths, and whose times rise strictly, merge associatively: at each leaf
    and atomic object the last one counts, arrays without keys join in order, of keyed items the last one of a key (with
    its priority field, if any has it), and what is noted for a field goes with its value. Where a path is an object in one
    version and a leaf in another, where only some versions are noted, or where items of one key pair up by count, the
    result depends on what is merged first.
    """
    found: dict[str, str] = {}

    def walk(node: dict, path: str) -> bool:
        notes = _notes(node)
        for name, child in node.items():
            if name == CASE_BY_FIELD:
                continue
            at = f"{path}.{name}" if path else name
            noted = "noted" if name in notes else "bare"
            if at in policy.arrays and isinstance(child, list):
                kind, spec = "array", policy.item_keys.get(at)
                if spec is not None and len({match_key(x, spec) for x in child}) < len(child):
                    return False
            elif at in policy.atomic and isinstance(child, dict):
                kind = f"atomic {noted}"
            elif isinstance(child, dict):
                kind = "object"
                if not walk(child, at):
                    return False
            else:
                kind = f"leaf {noted}"
            if found.setdefault(at, kind) != kind:
                return False
        return True

    return found if walk(tree, "") else None


def joint_shape(a: dict[str, str] | None, b: dict[str, str] | None) -> dict[str, str] | None:
    if a is None or b is None:
        return None
    few, many = (b, a) if len(b) < len(a) else (a, b)
    if any(many.get(path, kind) != kind for path, kind in few.items()):
        return None
    return many if few.keys() <= many.keys() else a | b


def _notes(node: dict) -> dict:
    found = node.get(CASE_BY_FIELD)
    return found if isinstance(found, dict) else {}


def _objects(a: dict, b: dict, a_wins: bool, policy: Policy, path: str) -> dict:
    noted = _notes(a), _notes(b)
    if not noted[0] and not noted[1]:
        return _bare_objects(a, b, a_wins, policy, path)
    best, other = noted if a_wins else noted[::-1]
    out: dict[str, Any] = {}
    notes: dict[str, Any] = {}
    for name in dict.fromkeys([*a, *b]):
        if name == CASE_BY_FIELD:
            continue
        at = f"{path}.{name}" if path else name
        if name not in a or name not in b:
            out[name] = a[name] if name in a else b[name]
            sources = (noted[0],) if name in a else (noted[1],)
        else:
            x, y = a[name], b[name]
            sources = (best,)
            if at in policy.arrays and isinstance(x, list) and isinstance(y, list):
                out[name] = _arrays(x, y, tuple(_case(n, name) for n in noted), a_wins, policy, at)
                sources = ()
            elif at in policy.atomic and isinstance(x, dict) and isinstance(y, dict):
                out[name] = _atomic(*((x, y) if a_wins else (y, x)), _case(other, name), policy.atomic[at])
                sources = (best,) if _case(best, name) else ()
            elif isinstance(x, dict) and isinstance(y, dict):
                out[name] = _objects(x, y, a_wins, policy, at)
                sources = ()
            else:
                out[name] = x if a_wins else y
                sources = (best, other) if x == y and type(x) is type(y) else (best,)
        source = next((s for s in sources if name in s), None)
        if source is not None:
            notes[name] = source[name]
    if notes:
        out[CASE_BY_FIELD] = notes
    return out


def _bare_objects(a: dict, b: dict, a_wins: bool, policy: Policy, path: str) -> dict:
    """``_objects`` where nothing is noted: only the fields of both are looked at."""
    out = a | b
    out.pop(CASE_BY_FIELD, None)
    few, many = (b, a) if len(b) < len(a) else (a, b)
    for name in few:
        if name not in many or name == CASE_BY_FIELD:
            continue
        at, x, y = f"{path}.{name}" if path else name, a[name], b[name]
        if at in policy.arrays and isinstance(x, list) and isinstance(y, list):
            out[name] = _arrays(x, y, (None, None), a_wins, policy, at)
        elif at in policy.atomic and isinstance(x, dict) and isinstance(y, dict):
            out[name] = _atomic(*((x, y) if a_wins else (y, x)), None, policy.atomic[at])
        elif isinstance(x, dict) and isinstance(y, dict):
            out[name] = _objects(x, y, a_wins, policy, at)
        else:
            out[name] = x if a_wins else y
    return out


def _case(notes: dict, name: str) -> str | None:
    found = notes.get(name)
    return None if found is None or isinstance(found, (dict, list)) else text_of(found)


def _atomic(winner: dict, loser: dict, loser_case: str | None, slots: tuple[str, ...]) -> dict:
    """The winner as it is; of the named slots, those that only the loser has are carried over with their case."""
    out = {k: v for k, v in winner.items() if k != CASE_BY_FIELD and k not in slots}
    notes = {}
    for slot in slots:
        if slot in winner:
            out[slot], case = winner[slot], _case(_notes(winner), slot)
        elif slot in loser:
            out[slot], case = loser[slot], _case(_notes(loser), slot) or loser_case
        else:
            continue
        if case:
            notes[slot] = case
    return out | ({CASE_BY_FIELD: notes} if notes else {})


def _tagged(item: Any, case: str | None) -> Any:
    if isinstance(item, dict) and case and SOURCE_CASE not in item:
        return item | {SOURCE_CASE: case}
    return item


def _arrays(a: list, b: list, cases: tuple[str | None, str | None], a_wins: bool, policy: Policy, path: str) -> list:
    """Items of both sides. With a key spec, equal items of a key count once and different ones collide pairwise."""
    spec = policy.item_keys.get(path)
    if spec is None:
        return [_tagged(x, case) for side, case in zip((a, b), cases, strict=True) for x in side]
    by_key: dict[str, tuple[list, list]] = defaultdict(lambda: ([], []))
    for side, items in enumerate((a, b)):
        for item in items:
            by_key[match_key(item, spec)][side].append((_content(item), item))
    winner, out = (0 if a_wins else 1), []
    wanted = policy.priority.get(path)
    for mine, theirs in by_key.values():
        # multiset intersection by content
        waiting = defaultdict(list)
        for entry in theirs:
            waiting[entry[0]].append(entry)
        rest = []
        for entry in mine:
            if waiting[entry[0]]:
                twin = waiting[entry[0]].pop(0)
                out.append(_tagged((entry, twin)[winner][1], cases[winner]))
            else:
                rest.append(entry)
        left = [sorted(rest, key=lambda e: e[0]), sorted((e for es in waiting.values() for e in es), key=lambda e: e[0])]
        pairs = min(map(len, left))
        for pair in zip(left[0][:pairs], left[1][:pairs], strict=True):
            has = [bool(wanted) and isinstance(e[1], dict) and wanted in e[1] for e in pair]
            side = has.index(True) if has[0] != has[1] else winner
            out.append(_tagged(pair[side][1], cases[side]))
        for side in (0, 1):
            out += [_tagged(e[1], cases[side]) for e in left[side][pairs:]]
    return out


def join_parts(parts: Mapping[str, dict], discriminators: Mapping[str, str], base: str | None, arrays: frozenset[str]) -> dict:
    """The parts (sub-type -> payload) of one contribution as one record.

    The base part gives its fields, every other part its discriminating field, and the merge arrays of all parts are
    joined, the base's items first.
    """
    names = sorted(parts)
    if base is None:
        base = next((n for n in names if isinstance(parts[n].get(discriminators.get(n, "")), list)), names[0])
    others = [n for n in names if n != base]
    out = dict(parts.get(base, {}))
    for n in others:
        chosen = discriminators.get(n)
        if chosen in parts[n]:
            out[chosen] = parts[n][chosen]
    for path in sorted(arrays):
        joined = [out.get(path), *[parts[n].get(path) for n in others]]
        out[path] = [x for items in joined if isinstance(items, list) for x in items]
    return out


def tag_proofs(payload: dict, path: str, label: str) -> dict:
    """Mark the items of a part's proof array with the part's label; other parts' items are left out of a review."""
    items = payload.get(path)
    if not isinstance(items, list) or label not in ("Authentication", "Document_Review"):
        return payload
    kept = items if label == "Authentication" else [x for x in items if not (isinstance(x, dict) and x.get("authenticationType") == "Authentication")]
    return payload | {path: [x | {"authenticationType": label} if isinstance(x, dict) else x for x in kept]}
