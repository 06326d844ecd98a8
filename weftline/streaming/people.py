"""Records of people kept up to date as facts arrive, with keyed state.

The state of a key is one value for each field with the order number that it came with,
and an entry for each list item. Updates ask only which order number is lower (or, of
strong facts, higher), so facts may come in any order and in any batches, and the last
row of a key equals its record in people.upserted() of all facts. State and updates go
with the new facts; only the items of the key at hand are read to write its row.

Needs the RocksDB state store (spark.sql.streaming.stateStore.providerClass).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from weftline.operators.people import CHANGING, FACT, LASTING, PAIRS, RECORD, SETS

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FIELDS = ("name", *CHANGING, *LASTING)


def _said(column: str, value: str | None) -> str | None:
    value = (value or "").strip(" ")
    return None if not value or column == "gender" and value == "Unknown" else value


def _items(fact: Row) -> Iterator[tuple[str, str, tuple]]:
    """field, id and (a, b, c) of the list items of a fact, in order."""
    for f in SETS:
        for x in fact[f] or ():
            if x is not None and x.strip(" "):
                yield f, x.strip(" "), (x.strip(" "), None, None)
    for x in fact["spouses"] or ():
        if x["key"]:
            yield "spouses", x["key"], (x["key"], x["relation"] or None, None)
    for x in fact["relationships"] or ():
        yield "relationships", f"{x['with'] or ''}\0{x['type'] or ''}", (x["with"], x["type"], x["note"])


class Upserts(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"{c} string, {c}_ord long, {c}_strong boolean" for c in _FIELDS)
        self.fields = handle.getValueState("fields", fields)
        self.items = handle.getMapState("items", "field string, id string", "ord long, place int, a string, b string, c string, relation string, relation_ord long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = [f"{c}{x}" for c in _FIELDS for x in ("", "_ord", "_strong")]
        state = dict(zip(names, self.fields.get() if self.fields.exists() else [None] * len(names), strict=True))
        for fact in rows:
            self._fields(state, fact)
            for place, (field, id_, (a, b, c)) in enumerate(_items(fact)):
                self._item((field, id_), fact["ord"], place, a, b, c)
        self.fields.update(tuple(state[n] for n in names))
        yield self._record(key[0], state)

    def close(self) -> None:
        pass

    @staticmethod
    def _fields(state: dict, fact: Row) -> None:
        for c in _FIELDS:
            value = (fact[c].strip(" ") if fact[c] is not None else None) if c == "name" else _said(c, fact[c])
            if value is None and c != "name":
                continue
            strong, had, at = c in CHANGING and bool(fact["strong"]), bool(state[f"{c}_strong"]), state[f"{c}_ord"]
            if at is None or (fact["ord"] > at if had else True) and strong or not strong and not had and fact["ord"] < at:
                state[c], state[f"{c}_ord"], state[f"{c}_strong"] = value, fact["ord"], strong

    def _item(self, at: tuple, ord_: int, place: int, a, b, c) -> None:
        old = self.items.getValue(at) if self.items.containsKey(at) else None
        relation, relation_ord = (b, ord_) if b is not None else (None, None)
        if old is not None:
            if old[6] is not None and (relation_ord is None or old[6] <= relation_ord):
                relation, relation_ord = old[5], old[6]
            if (old[0], old[1]) <= (ord_, place):
                ord_, place, a, b, c = old[:5]
        self.items.updateValue(at, (ord_, place, a, b, c, relation, relation_ord))

    def _record(self, key: str, state: dict) -> Row:
        own: dict[str, list] = {f: [] for f in (*SETS, *PAIRS)}
        for (field, _), item in self.items.iterator():
            own[field].append(tuple(item))
        for items in own.values():
            items.sort(key=lambda x: x[:2])
        lists = [[x[2] for x in own[f] if f != "aliases" or x[2] != state["name"]] for f in SETS]
        spouses = [Row(key=x[2], relation=x[5]) for x in own["spouses"]]
        relationships = [Row(**{"with": x[2], "type": x[3], "note": x[4]}) for x in own["relationships"]]
        fields = {c: state["gender"] or "Unknown" if c == "gender" else state[c] for c in (*CHANGING, *LASTING)}
        return Row(**({"key": key, "name": state["name"]} | fields | dict(zip(SETS, lists, strict=True)) | {"spouses": spouses, "relationships": relationships}))


def running_records(facts: DataFrame) -> DataFrame:
    """A stream of records (people.RECORD): for each batch those of the keys that it has facts of (people.FACT)."""
    own = facts.filter("key IS NOT NULL").select(*(x.split()[0] for x in _names(FACT)))
    return own.groupBy("key").transformWithState(Upserts(), RECORD, "Update", "None")


def _names(ddl: str) -> list[str]:
    from weftline.operators.knowledge import _fields

    return _fields(ddl)
