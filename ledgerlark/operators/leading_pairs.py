"""Pairs of rows and entities with alike names that can be the first choice of a cascade of rules, without a row for every pair.

A row's first choice is the least (rule, variant, -score, entity_id). Names of a country are compared in blocks of rows and batches of
entities, with the bit-parallel count of similarity.py on arrays of names. Of a pair everything but the address is known then, so its
place in that order has two bounds, with an address that agrees and with one that doesn't. Pairs are looked at by the better bound, and
addresses compared, until no other can come before the best one found; pairs as good as that leave the task, and the cascade's own
expressions decide among them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.similarity import ALPHABET, address_value

#: Scores and addresses that differ by less are taken for equal here.
SLACK = 1e-9
#: Stands for no rule.
NEVER = 1 << 20
LETTER = np.zeros(128, np.uint8)
LETTER[[ord(c) for c in ALPHABET]] = np.arange(1, len(ALPHABET) + 1)


class Names:
    """Plain names as arrays of letter codes."""

    def __init__(self, names: list[str]):
        self.names, self.n = names, np.array([len(x) for x in names], np.int64)
        self.codes = np.zeros((int(self.n.max(initial=0)), len(names)), np.uint8)
        for k, name in enumerate(names):
            self.codes[: len(name), k] = LETTER[np.frombuffer(name.encode(), np.uint8)]

    def ratios(self, name: str, at: np.ndarray) -> np.ndarray:
        """2 * LCS / (|a| + |b|) of a name, not empty, with those at these places."""
        n, codes = len(name), LETTER[np.frombuffer(name.encode(), np.uint8)]
        masks = np.zeros((-(-n // 64), len(ALPHABET) + 1), np.uint64)
        for i, c in enumerate(codes):
            masks[i >> 6, c] |= np.uint64(1 << (i & 63))
        state = [np.full(len(at), np.uint64(0xFFFFFFFFFFFFFFFF)) for _ in masks]
        for row in self.codes[: int(self.n[at].max(initial=0))]:
            own, carry = row[at], None
            for w, mask in enumerate(masks):
                v, m = state[w], mask[own]
                u = v & m
                total = v + u
                over = total < u
                if carry is not None:
                    total = total + carry
                    over |= total < carry
                state[w], carry = total | (v & ~m), over.astype(np.uint64)
        common = np.zeros(len(at), np.int64)
        for w, v in enumerate(state):
            full = np.uint64((1 << min(64, n - 64 * w)) - 1)
            common += np.bitwise_count(~v & full)
        return 2 * common / (n + self.n[at])


def scores(name: np.ndarray, street: np.ndarray, geo: np.ndarray, state: np.ndarray, slack: float) -> np.ndarray:
    """match_score() of alike names (.80 or more)."""
    strong, near = name >= 0.90, street + slack >= 0.80
    rise = lambda x, least, weight: np.where(x < least, 0.0, weight * (x - least) / (1.0 - least))
    return np.select(
        [strong & near & geo, strong & geo, near & geo, geo, strong & state, strong],
        [np.minimum(0.85 + (rise(name, 0.90, 0.05) + rise(street, 0.80, 0.03)), 0.99), np.minimum(0.80 + rise(name, 0.90, 0.05), 0.90), np.minimum(0.80 + rise(name, 0.80, 0.10), 0.90),
         np.minimum(0.75 + rise(name, 0.80, 0.15), 0.88), np.minimum(0.80 + rise(name, 0.90, 0.10), 0.85), np.minimum(0.80 + rise(name, 0.90, 0.05), 0.88)],
        np.minimum(0.65 + rise(name, 0.80, 0.15), 0.78))


class Entities:
    """A batch of entities, with what rows ask of them by their cities, states and postal codes."""

    def __init__(self, batch):
        field = lambda name: batch.column(name).to_pylist()
        self.ids, self.street = field("entity_id"), field("street")
        plain = [field("legal"), field("dba")]
        distinct = {x: i for i, x in enumerate(dict.fromkeys(plain[0] + plain[1]))}
        self.names, self.sides = Names(list(distinct)), np.array([[distinct[x] for x in side] for side in plain])
        self.whole = [self.places(field(c)) for c in ("legal_whole", "dba_whole")]
        self.n, self.cities, self.states = len(self.ids), self.places(field("city")), self.places(field("state"))
        self.codes: dict[str, list[int]] = {}
        for k, code in enumerate(field("code")):
            for i in range(1, len(code) + 1):
                self.codes.setdefault(code[:i], []).append(k)
        self._cities: dict[str | None, dict[str, np.ndarray]] = {}

    def places(self, values: list) -> dict:
        out: dict = {}
        for k, v in enumerate(values):
            out.setdefault(v, []).append(k)
        return out

    def flags(self, at: Sequence[int]) -> np.ndarray:
        out = np.zeros(self.n, bool)
        out[at] = True
        return out

    def place(self, city: str | None, state: str, code: str) -> dict[str, np.ndarray]:
        if city not in self._cities:
            near = lambda holds: self.flags([k for c, at in self.cities.items() if holds(c or "") for k in at] if city else [])
            self._cities[city] = {"city": self.flags(self.cities.get(city, []) if city is not None else []), "city in": near(lambda c: city in c), "city starts": near(lambda c: c.startswith(city))}
        same = self.flags(self.states.get(state, []))
        return {**self._cities[city], "state": same if state else self.flags([]), "same state": same, "postal": self.flags(self.codes.get(code, []) if code else [])}


class Choice:
    """What is known of one row: its best place in the order, and the pairs that may have it."""

    def __init__(self) -> None:
        self.best: tuple[int, int, float] = (NEVER, 0, 0.0)
        self.pairs: dict = {}

    def meets(self, rule, variant: int, score):
        r, v, s = self.best
        return (rule < r) | ((rule == r) & ((variant < v) | ((variant == v) & (score >= s - SLACK))))

    def bound(self, rule: int, variant: int, score: float) -> None:
        r, v, s = self.best
        if (rule, variant, -score) < (r, v, -s):
            self.best = rule, variant, score
            self.pairs = {k: x for k, x in self.pairs.items() if self.meets(k[0], k[1], k[2])}

    def add(self, key: tuple, entity) -> None:
        """Pairs alike in all that a score is made of differ by their entity_id only."""
        old = self.pairs.get(key)
        if old is None or entity < old:
            self.pairs[key] = entity


def first_rules(rules, floors: list[float], legal: np.ndarray, dba: np.ndarray, equal: list[np.ndarray], place: dict, street: np.ndarray, score: np.ndarray, fuzzy: float, slack: float) -> np.ndarray:
    """The first rule that each pair of alike names meets by its ratios or equal names; other ways to agree come after rule 10 and are equal keys."""
    out = np.full(len(score), NEVER)
    for rule, floor in zip(reversed(rules), reversed(floors)):
        sides = [{"fuzzy": r >= fuzzy, "equal": e}.get(kind) for kind, r, e in ((rule.legal, legal, equal[0]), (rule.dba, dba, equal[1]))]
        if rule.legal or rule.dba:
            if sides[0] is None and sides[1] is None:
                continue
            holds = np.logical_or(*(False if s is None else s for s in sides))
        else:
            holds = np.ones(len(score), bool)
        for p in rule.place:
            holds = holds & (street + slack >= 0.80 if p == "street" else place[p])
        out[holds & (score > 0) & (score + slack >= floor)] = rule.number
    return out


def choose(row: dict, entities: Entities, known: Choice, rules, floors: list[float], fuzzy: float) -> None:
    """Lets a row meet a batch of entities, those of its postal code first: their rules come early, and then few others count."""
    if row["code"] not in entities.codes and all("postal" in r.place for r in rules if r.number <= known.best[0]):
        return
    place = entities.place(row["city"], row["state"], row["code"])
    geo = place["city"] | place["postal"]
    reach = np.full(entities.n, NEVER)  # the first rule that alike names would meet
    for rule in reversed(rules):
        if rule.number <= known.best[0]:
            holds = [place[p] for p in rule.place if p != "street"]
            reach[np.logical_and.reduce(holds) if holds else slice(None)] = rule.number
    tried = {(x["plain"], x["lower"]): x["variant"] for x in reversed(row["tried"]) if x["plain"]}  # what was tried under an earlier variant comes first there
    for part, (plain, lower), variant in [(part, *x) for part in np.split(np.argsort(~place["postal"], kind="stable"), [place["postal"].sum()]) for x in sorted(tried.items(), key=lambda x: x[1])]:
        first, second, _ = known.best
        at = part if row["odd"] else part[(reach[part] < first) | ((reach[part] == first) & (variant <= second) & (first < NEVER))]
        if not len(at):
            continue
        used, back = np.unique(entities.sides[:, at], return_inverse=True)
        legal, dba = entities.names.ratios(plain, used)[back.reshape(2, -1)]
        both = np.maximum(legal, dba)
        kept = both >= fuzzy
        at, legal, dba, both = at[kept], legal[kept], dba[kept], both[kept]
        if row["odd"]:
            known.pairs.update({(NEVER, 0, 0.0, entities.ids[k]): entities.ids[k] for k in at.tolist()})
            continue
        if not len(at):
            continue
        equal = [entities.flags(side.get(lower, []))[at] for side in entities.whole]
        here, near = {k: v[at] for k, v in place.items()}, geo[at]

        def order(street: np.ndarray, slack: float, own=slice(None)):  # noqa: B023
            part = {k: v[own] for k, v in here.items()}
            score = scores(both[own], street, near[own], part["same state"], slack)
            return first_rules(rules, floors, legal[own], dba[own], [e[own] for e in equal], part, street, score, fuzzy, slack), score

        def settle(own: np.ndarray, rule: np.ndarray, score: np.ndarray, least: np.ndarray, low: np.ndarray, street: np.ndarray) -> None:
            """The pairs `own`, whose addresses are known: their places with and against the slack."""
            first = np.lexsort((-low, least))[0]
            if least[first] < NEVER:
                known.bound(int(least[first]), variant, float(low[first]))
            for i in np.flatnonzero(known.meets(rule, variant, score) & (rule < NEVER)).tolist():
                k = own[i]
                known.add((int(rule[i]), variant, float(score[i]), float(both[k]), float(street[i]), bool(near[k]), bool(here["same state"][k])), entities.ids[at[k]])

        (rule, score), (least, low) = order(np.where(near, 1.0, 0.0), SLACK), order(np.zeros(len(at)), -SLACK)
        first = np.lexsort((-low, least))[0]
        if least[first] < NEVER:
            known.bound(int(least[first]), variant, float(low[first]))
        left = np.flatnonzero(known.meets(rule, variant, score) & (rule < NEVER))
        asks = near[left] & (row["street"] is not None)
        sure = left[~asks]  # an address makes no difference, or there is none
        if len(sure):
            none = np.zeros(len(sure))
            settle(sure, *order(none, SLACK, sure), *order(none, -SLACK, sure), none)
        left, step = left[asks], 1
        left = left[np.lexsort((-score[left], rule[left]))]
        while len(left):
            some, left, step = left[:step], left[step:], min(2 * step, 64)
            some = some[known.meets(rule[some], variant, score[some])]
            if not len(some):
                break
            street = np.array([0.0 if entities.street[at[k]] is None else address_value(row["street"], entities.street[at[k]]) for k in some.tolist()])
            settle(some, *order(street, SLACK, some), *order(street, -SLACK, some), street)


def leading_pairs(rows: DataFrame, entities: DataFrame, rules, floors: list[float], fuzzy: float, block: int = 1024, cells: int = 64) -> DataFrame:
    """(row_id, entity_id, settled) of the pairs of alike names that may be a row's first choice, by rules that ask for alike or equal
    names. settled: the row surely meets a rule that comes before all that names can meet otherwise. Rows with a name to try that has
    no Latin letter or digit (odd) give every pair with alike names.

    rows: row_id, grp, tried (variant, plain, lower), city (null if there is none), state, code, street (null likewise); entities:
    entity_id, grp, legal, dba, legal_whole, dba_whole, city, state, code, street. Rows of a group are dealt to blocks by postal code,
    and meet entities of their own block's codes first; a code of very many rows gives several blocks.
    """
    cell = lambda key: F.pmod(F.xxhash64(F.when(F.col("code") != "", F.col("code")).otherwise(F.col(key).cast("string"))), F.lit(cells)).cast("int")
    rows, entities = rows.withColumn("cell", cell("row_id")), entities.where("entity_id is not null").withColumn("cell", cell("entity_id"))
    ahead = Window.partitionBy("grp").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("grp", "cell").count().withColumn("block", F.floor(F.coalesce(F.sum("count").over(ahead), F.lit(0)) / block).cast("int"))
    parts = parts.withColumn("subs", F.ceil(F.sum("count").over(Window.partitionBy("grp", "block")) / (2 * block)).cast("int"))
    blocks = parts.groupBy("grp", "block").agg(F.min("cell").alias("low"), F.max("cell").alias("high"), F.first("subs").alias("subs"))
    task = ["grp", "block", "sub"]
    asked = rows.join(F.broadcast(parts.select("grp", "cell", "block", "subs")), ["grp", "cell"]).select(
        "grp", "block", F.pmod(F.xxhash64(F.col("row_id").cast("string")), F.col("subs")).cast("int").alias("sub"), F.lit(0).alias("kind"), F.struct("row_id", "tried", "city", "state", "code", "street", "odd").alias("r"))
    known = entities.join(F.broadcast(blocks), "grp").select(
        "grp", "block", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), F.when(F.col("cell").between(F.col("low"), F.col("high")), 1).otherwise(2).alias("kind"),
        F.struct("entity_id", "legal", "dba", "legal_whole", "dba_whole", "city", "state", "code", "street").alias("e"))
    met = asked.unionByName(known, allowMissingColumns=True)
    met = met.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *task).sortWithinPartitions(*task, "kind")
    settled = min(r.number for r in rules if {r.legal, r.dba} - {None, "fuzzy", "equal"})

    def run(batches):
        import pyarrow as pa

        now, asked, choices = None, [], []

        def found():
            held = [(i, e, c.best[0] < settled) for i, c in enumerate(choices) for e in c.pairs.values()]
            if held:
                ids = pa.chunked_array([x.column("row_id") for x in asked]).combine_chunks()
                i, e, s = zip(*held)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(i)), pa.array(e, entity_type), pa.array(s)], ["row_id", "entity_id", "settled"])

        entity_type, texts = None, []
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*task, "kind"))))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a][:3] != now:
                    yield from found()
                    now, asked, texts, choices = keys[a][:3], [], [], []
                side = pa.RecordBatch.from_struct_array(part.column("r" if keys[a][3] == 0 else "e"))
                if keys[a][3] == 0:
                    asked.append(side)
                    texts += side.drop_columns(["row_id"]).to_pylist()
                    choices += [Choice() for _ in range(b - a)]
                else:
                    entity_type, batch_of = side.schema.field("entity_id").type, Entities(side)
                    for row, choice in zip(texts, choices):
                        choose(row, batch_of, choice, rules, floors, fuzzy)
        yield from found()

    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((rows, "row_id"), (entities, "entity_id"))}
    return met.mapInArrow(run, f"row_id {kinds['row_id']}, entity_id {kinds['entity_id']}, settled boolean")
