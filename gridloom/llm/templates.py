"""Template deduction from markup signs: equivalence classes, their nesting, and the slots of each record.

1. Token types with the same occurrence vector over the records of a source
   (equal counts in each) form an equivalence class. Vectors are compared as
   sums of hashes, so that no vector is gathered.
2. A class is valid if its tokens come in one order, over and over, in every
   record; one that is not is split into the largest parts that do.
3. Classes nest if they never overlap other than one within a slot of the other,
   that is between two following tokens of it; of two that do, the one of the
   lower support is dropped. The parent of a class is the innermost class that
   holds all of its occurrences in one and the same slot.
4. Tokens take the slot that they stand in as their role, and classes of roles
   are sought again, until no role is split any more.
5. Slots are the texts between the tokens of a class in a record; a class that
   lies within is cut out and has slots of its own.

Tokens are markup signs only; contents are what the slots hold. Each step looks
at all records: a class that fails in one is not valid. A map over the signs of
a record needs the classes of its source, which are bounded by the vocabulary of
the markup, not by the records.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import cut_lineage, ship_package

#: Records of a source that a template class must appear in at least.
SUPPORT = 3

_START, _END = r"(?<![^\n\r\u0085\u2028\u2029])", r"(?![^\n\r\u0085\u2028\u2029])"
_TOKEN = re.compile(
    r"(?=[<\\#= {|}!*\[\]'`$>0-9-])(?:</?[A-Za-z][A-Za-z0-9]*(?: class=\"[a-z0-9]*\"| border=\"[0-9]*\")?|\\(?:begin|end)\{[a-z]*\}|\\[a-z]+"
    rf"|{_START}\#{{1,6}} |{_START}={{2,6}} | ={{2,6}}{_END}|\{{\||\|\}}|!!|\|\||\*\*|\[\[|\]\]|\]\(|\{{\{{|\}}\}}|'''|```|\$\$|{_START}[-*] |{_START}> |{_START}[0-9]+\. )"
)
_CLOSE = re.compile(r"\s*/?>")
_SPLIT = "\t"  # between a token and its role; no token holds one


def _number(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(json.dumps(parts).encode(), digest_size=8).digest(), "big", signed=True)


@lru_cache(1_000)
def _members(classes: str) -> dict[str, tuple[int, int, int]]:
    """``role -> (class, its place in it, tokens of the class)``."""
    return {role: (c["id"], i, len(c["roles"])) for c in json.loads(classes) for i, role in enumerate(c["roles"])}


@lru_cache(100_000)
def _finer(role: str, name: int, slot: int) -> str:
    """The role of a token that stands in a slot."""
    return role.split(_SPLIT)[0] + _SPLIT + format(_number(role, name, slot) & (1 << 64) - 1, "x")


def _tallies(rows: list[list[str]]) -> list[pa.Array]:
    """The roles of each row once, how often they occur, and the places of their first and last occurrence."""
    out = ([], [], [], [])
    for row in rows:
        n, last = Counter(row), {role: i for i, role in enumerate(row)}
        first = {row[i]: i for i in range(len(row) - 1, -1, -1)}
        for column, values in zip(out, (n, n.values(), map(first.__getitem__, n), map(last.__getitem__, n))):
            column.append(list(values))
    return [pa.array(column, pa.list_(kind)) for column, kind in zip(out, (pa.string(), pa.int32(), pa.int32(), pa.int32()))]


def orders_of(roles: list[str], members: dict[str, tuple[int, int, int]]) -> dict[int, tuple[str, ...]]:
    """The tokens of each class of a record in their order; if they don't repeat one order, all of them."""
    seen = defaultdict(list)
    for role in roles:
        if role in members:
            seen[members[role][0]].append(role)
    out = {}
    for name, row in seen.items():
        size = members[row[0]][2]
        out[name] = tuple(row[:size] if row[:size] * (len(row) // size) == row else row)
    return out


def broken_pairs(row: tuple[str, ...]) -> set[tuple[str, str]]:
    """Pairs (a, b) of which a and b don't take turns, a first."""
    at = defaultdict(list)
    for i, role in enumerate(row):
        at[role].append(i)
    fits = lambda a, b: all(x < y for x, y in zip(at[a], at[b])) and all(y < x for x, y in zip(at[a][1:], at[b]))
    return {(a, b) for a in at for b in at if a != b and not fits(a, b)}


def ordered_parts(tokens: list[str], broken: set[tuple[str, str]]) -> list[list[str]]:
    """The tokens of a class in parts within which any two take turns in every record, each in its order."""
    parts: list[list[str]] = []
    for t in tokens:
        for part in parts:
            if all((t, x) not in broken or (x, t) not in broken for x in part):
                part.insert(sum((x, t) not in broken for x in part), t)
                break
        else:
            parts.append([t])
    return [p for p in parts if len(p) > 1]


def relations(roles: list[str], members: dict[str, tuple[int, int, int]]) -> Counter:
    """Occurrences by (outer class, inner class, slot); the slot is -1 if they overlap, and 0 of a class with itself counts all."""
    open_: dict[int, tuple[int, int]] = {}  # class -> occurrence, slot
    begun: dict[int, dict[int, tuple[int, int]]] = {}
    number, out = Counter(), Counter()
    for role in roles:
        if role not in members:
            continue
        name, place, size = members[role]
        if place == 0:
            begun[name] = dict(open_)
            number[name] += 1
        if place < size - 1:
            open_[name] = (number[name], place + 1)
            continue
        del open_[name]
        out[name, name, 0] += 1
        for outer, where in begun[name].items():
            out[outer, name, where[1] if open_.get(outer) == where else -1] += 1
    return out


def nested(classes: list[tuple[int, int, int]], found: list[tuple[int, int, int, int]]) -> dict[int, tuple[int | None, int | None, int]]:
    """``class -> (parent, its slot, depth)`` of the classes (id, support, tokens) that overlap no kept one; ``found`` are relations with their counts."""
    slots, total, cross = defaultdict(dict), {}, set()
    for outer, inner, slot, n in found:
        if outer == inner:
            total[inner] = n
        elif slot < 0:
            cross |= {(outer, inner), (inner, outer)}
        else:
            slots[inner].setdefault(outer, {})[slot] = n
    kept: list[int] = []
    for name, _, _ in sorted(classes, key=lambda c: (-c[1], -c[2], c[0])):
        if all((name, k) not in cross for k in kept):
            kept.append(name)
    held = {k: {o: next(iter(s)) for o, s in slots[k].items() if o in kept and list(s.values()) == [total[k]]} for k in kept}
    out = {}
    for k in kept:
        parent = max(held[k], key=lambda o: (len(held[o]), o), default=None)
        out[k] = (parent, held[k].get(parent), len(held[k]))
    return out


def places(roles: list[str], members: dict[str, tuple[int, int, int]]) -> list[tuple[int, int] | None]:
    """The innermost class and slot that each token stands in, other than its own class."""
    out, stack = [], []
    for role in roles:
        if role not in members:
            out.append(tuple(stack[-1]) if stack else None)
            continue
        name, place, size = members[role]
        if place == 0:
            out.append(tuple(stack[-1]) if stack else None)
            stack.append([name, 1])
        else:
            out.append(tuple(stack[-2]) if len(stack) > 1 else None)
            stack[-1][1] = place + 1
            if place == size - 1:
                stack.pop()
    return out


def slots_of(text: str, roles: list[str], members: dict[str, tuple[int, int, int]]) -> list[dict]:
    """Slots of a text: class, number of its occurrence, slot, the slot around it, and its text in parts around the classes within."""
    out, stack, number = [], [], Counter()
    for role, match in zip(roles, _TOKEN.finditer(text), strict=True):
        if role not in members:
            continue
        name, place, size = members[role]
        if place == 0:
            if stack:
                stack[-1]["parts"].append(text[stack[-1]["from"] : match.start()])
            around = {f"in_{k}": stack[-1][k] if stack else None for k in ("class", "nth", "slot")}
            number[name] += 1
        else:
            slot = stack.pop()
            slot["parts"].append(text[slot.pop("from") : match.start()])
            out.append(slot)
            around = {k: slot[k] for k in ("in_class", "in_nth", "in_slot")}
        begin = match.end()
        if match.group().startswith("<") and (close := _CLOSE.match(text, begin)):
            begin = close.end()
        if place < size - 1:
            stack.append({"class": name, "nth": number[name], "slot": place + 1, **around, "parts": [], "from": begin})
        elif stack:
            stack[-1]["from"] = begin
    return out


_KEYS, _KEY_TYPES = ["tab", "rec_id", "source", "mark"], "tab string, rec_id bigint, source string, mark bigint"
_SIGNS, _SIGN_TYPES = ["roles", "role", "n", "first", "last"], "roles array<string>, role array<string>, n array<int>, first array<int>, last array<int>"


def _signs(texts: DataFrame) -> DataFrame:
    """The signs of each record once and their tallies; ``mark`` tells the row that was taken of a repeated key."""
    ship_package(texts.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [_TOKEN.findall(t) for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(signs, pa.list_(pa.string())), *_tallies(signs)], names=_KEYS + _SIGNS)

    rows = texts.where("text is not null").select("tab", "rec_id", "source", F.xxhash64("source", "text").alias("mark"), "text")
    signs = rows.mapInArrow(read, f"{_KEY_TYPES}, {_SIGN_TYPES}")
    one = signs.groupBy("tab", "rec_id").agg(F.min_by(F.struct("source", "mark", *_SIGNS), "mark").alias("r")).select("tab", "rec_id", "r.*")
    return one.where(F.size("roles") > 0)


def _by_source(classes: DataFrame) -> DataFrame:
    return classes.groupBy("source").agg(F.to_json(F.collect_list(F.struct("id", "roles"))).alias("classes")).withColumnRenamed("source", "of")


def _beside(rows: DataFrame, classes: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the classes of their source."""
    by = _by_source(classes)
    return rows.join(by, F.col("source").eqNullSafe(F.col("of")), how).drop("of")


def _vectors(roles: DataFrame) -> DataFrame:
    """``(source, role, support, v1, v2, first, last)``: occurrence vectors of role types, as hashes, and their mean places."""
    per = roles.select("source", F.xxhash64("tab", "rec_id").alias("rec"), F.inline(F.arrays_zip("role", "n", "first", "last")))
    cell = F.xxhash64("rec", "n")
    return per.groupBy("source", "role").agg(
        F.count("*").alias("support"), F.bit_xor(cell).alias("v1"), F.sum(F.shiftrightunsigned(cell, 20).cast("decimal(20,0)")).alias("v2"), F.avg("first").alias("first"), F.avg("last").alias("last")
    )


def _equal(vectors: DataFrame) -> DataFrame:
    """``(source, support, id, first, last, roles)``: role types of equal occurrence vectors, by their mean first places."""
    classes = vectors.where(F.col("support") >= SUPPORT).groupBy("source", "support", "v1", "v2").agg(F.sort_array(F.collect_list(F.struct("first", "role", "last"))).alias("t"))
    ident = F.xxhash64("source", "support", "v1", "v2").alias("id")
    return classes.where(F.size("t") > 1).select("source", "support", ident, F.col("t.first").alias("first"), F.col("t.last").alias("last"), F.col("t.role").alias("roles"))


def _valid(roles: DataFrame, vectors: DataFrame) -> DataFrame:
    """``(source, support, id, n_first, n_last, roles, parent, parent_slot, depth)``: ordered classes, nested."""
    equal = cut_lineage(_equal(vectors))

    pairs = pa.schema([("id", pa.int64()), ("a", pa.string()), ("b", pa.string())])

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sent = set(), set()  # orders and pairs of the classes, not of the records
        for batch in batches:
            fresh = set()
            for row, classes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                members = _members(classes)
                for name, order in orders_of(row, members).items():
                    if len(order) > members[order[0]][2]:
                        fresh |= {(name, *pair) for pair in broken_pairs(order)}
                    elif (name, order) not in seen:
                        seen.add((name, order))
                        fresh |= {(name, *pair) for pair in broken_pairs(order)}
            fresh -= sent
            sent |= fresh
            yield pa.RecordBatch.from_pylist([dict(zip(pairs.names, f)) for f in fresh], pairs)

    broken = _beside(roles.select("source", "roles"), equal).select("roles", "classes").mapInArrow(orders, "id bigint, a string, b string")
    broken = broken.groupBy("id").agg(F.collect_set(F.struct("a", "b")).alias("broken"))
    schema = pa.schema([("source", pa.string()), ("support", pa.int64()), ("id", pa.int64()), ("n_first", pa.float64()), ("n_last", pa.float64()), ("roles", pa.list_(pa.string()))])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c in batch.to_pylist():
                first, last = dict(zip(c["roles"], c["first"])), dict(zip(c["roles"], c["last"]))
                for part in ordered_parts(c["roles"], {(p["a"], p["b"]) for p in c["broken"] or ()}):
                    out.append({"source": c["source"], "support": c["support"], "id": _number(c["source"], part), "n_first": min(first[t] for t in part), "n_last": max(last[t] for t in part), "roles": part})
            yield pa.RecordBatch.from_pylist(out, schema)

    ordered = equal.join(broken, "id", "left").select("source", "support", "first", "last", "roles", "broken")
    ordered = cut_lineage(ordered.mapInArrow(parts, "source string, support bigint, id bigint, n_first double, n_last double, roles array<string>"))
    edges = pa.schema([("source", pa.string()), ("outer", pa.int64()), ("inner", pa.int64()), ("slot", pa.int32()), ("n", pa.int64())])

    def relate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = Counter()
            for source, row, classes in zip(*(batch.column(k).to_pylist() for k in range(3))):
                for key, k in relations(row, _members(classes)).items():
                    n[source, *key] += k
            yield pa.RecordBatch.from_pylist([dict(zip(edges.names, (*key, k))) for key, k in n.items()], edges)

    found = _beside(roles.select("source", "roles"), ordered).select("source", "roles", "classes").mapInArrow(relate, "source string, outer bigint, inner bigint, slot int, n bigint")
    found = found.groupBy("source", "outer", "inner", "slot").agg(F.sum("n").alias("n")).groupBy("source").agg(F.collect_list(F.struct("outer", "inner", "slot", "n")).alias("found")).withColumnRenamed("source", "of")
    sources = ordered.groupBy("source").agg(F.collect_list(F.struct("id", "support", F.size("roles").alias("size"))).alias("all"))
    tree = pa.schema([("id", pa.int64()), ("parent", pa.int64()), ("parent_slot", pa.int32()), ("depth", pa.int32())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = nested([tuple(c.values()) for c in row["all"]], [tuple(f.values()) for f in row["found"]])
                yield pa.RecordBatch.from_pylist([dict(zip(tree.names, (k, *v))) for k, v in out.items()], tree)

    placed = sources.join(found, F.col("source").eqNullSafe(F.col("of"))).select("all", "found").mapInArrow(place, "id bigint, parent bigint, parent_slot int, depth int")
    return cut_lineage(ordered.join(placed, "id"))


def _deduced(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records with the roles of their signs, and the classes of these; roles are split by the slots they stand in until none is."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            finer = []
            for row, classes in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                where = places(row, _members(classes or "[]"))
                finer.append([r if w is None else _finer(r, *w) for r, w in zip(row, where)])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(finer, pa.list_(pa.string())), *_tallies(finer)], names=_KEYS + _SIGNS)

    roles = cut_lineage(_signs(texts))
    vectors = cut_lineage(_vectors(roles))
    n = vectors.count()
    while True:
        classes = _valid(roles, vectors)
        finer = cut_lineage(_beside(roles, classes, "left").select(*_KEYS, "roles", "classes").mapInArrow(split, f"{_KEY_TYPES}, {_SIGN_TYPES}"))
        vectors = cut_lineage(_vectors(finer))
        more = vectors.count()
        if more == n:  # renamed at most
            return roles, classes
        roles, n = finer, more


def template_classes(texts: DataFrame) -> DataFrame:
    """``(source, support, tokens, n_first, n_last, class, template, parent, parent_slot, depth)``: the nested classes of a source.

    ``tokens`` are the signs of the class by name, ``template`` in their order.
    ``n_first`` and ``n_last`` are the mean places of the first and last token.
    ``parent_slot`` is counted from 1, after the first token of the parent;
    ``depth`` is the number of classes that the class always lies within.
    """
    signs = F.transform("roles", lambda r: F.element_at(F.split(r, _SPLIT), 1))
    rows = _deduced(texts)[1].withColumn("template", signs)
    return rows.select(
        "source", "support", F.array_sort(F.array_distinct("template")).alias("tokens"), F.round("n_first", 3).alias("n_first"), F.round("n_last", 3).alias("n_last"),
        F.col("id").alias("class"), "template", "parent", "parent_slot", "depth",
    )


def template_slots(texts: DataFrame) -> DataFrame:
    """``(tab, rec_id, class, nth, slot, in_class, in_nth, in_slot, parts)``: the slots of each record, by class and number of its occurrence.

    ``parts`` are the pieces of text in the slot before, between and after the
    classes within it, whose own rows name it in ``in_class``, ``in_nth`` and ``in_slot``.
    """
    roles, classes = _deduced(texts)
    kind = "array<struct<class: bigint, nth: int, slot: int, in_class: bigint, in_nth: int, in_slot: int, parts: array<string>>>"
    number, small = pa.int64(), pa.int32()
    slot = pa.struct([("class", number), ("nth", small), ("slot", small), ("in_class", number), ("in_nth", small), ("in_slot", small), ("parts", pa.list_(pa.string()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [slots_of(t, r, _members(c)) for t, r, c in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(slot))], names=["tab", "rec_id", "slots"])

    texts = texts.where("text is not null").withColumn("mark", F.xxhash64("source", "text")).select(F.col("tab").alias("t"), F.col("rec_id").alias("i"), F.col("mark").alias("m"), "text")
    known = _beside(roles, classes)
    rows = known.join(texts, F.col("tab").eqNullSafe(F.col("t")) & F.col("rec_id").eqNullSafe(F.col("i")) & (F.col("mark") == F.col("m")))
    cuts = rows.select("tab", "rec_id", "text", "roles", "classes").mapInArrow(cut, f"tab string, rec_id bigint, slots {kind}")
    return cuts.dropDuplicates(["tab", "rec_id"]).select("tab", "rec_id", F.inline("slots"))
