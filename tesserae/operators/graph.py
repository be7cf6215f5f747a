"""Triples (s, p, o, s_kind, o_kind): building, patterns as joins, differences of two graphs."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tesserae.plans.compile import closure, needs_checkpoints


def triples(rows: DataFrame, subject: Column, facts: dict[str, Column], kinds: dict[str, str] | None = None) -> DataFrame:
    """One triple per row and non-null fact, in one pass."""
    each = [F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit((kinds or {}).get(p, "literal")).alias("o_kind")) for p, o in facts.items()]
    flat = rows.select(subject.alias("s"), F.explode(F.array(*each)).alias("f")).where("f.o IS NOT NULL")
    return flat.select("s", "f.p", "f.o", F.lit("iri").alias("s_kind"), "f.o_kind")


def pattern(graph: DataFrame, s: str, p: str, o: str) -> DataFrame:
    """Bindings of one triple pattern; names that begin with ? are variables, others must match."""
    rows, out, seen = graph, [], {}
    for column, term in (("s", s), ("p", p), ("o", o)):
        if not term.startswith("?"):
            rows = rows.where(F.col(column) == term)
        elif term in seen:
            rows = rows.where(F.col(column) == F.col(seen[term]))
        else:
            seen[term] = column
            out.append(F.col(column).alias(term[1:]))
    return rows.select(*out)


def basic(graph: DataFrame, *patterns: tuple[str, str, str], product: bool = False) -> DataFrame:
    """Patterns joined on the variables they share, in their order. One that shares none with those before it multiplies rows; that
    must be asked for."""

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        shared = [c for c in a.columns if c in b.columns]
        if not shared and not product:
            raise ValueError("a pattern shares no variable with those before it")
        return a.join(b, shared) if shared else a.crossJoin(b)

    return reduce(join, [pattern(graph, *x) for x in patterns])


def optional(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, [c for c in left.columns if c in right.columns], "left")


def not_exists(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, [c for c in left.columns if c in right.columns], "left_anti")


def path_plus(graph: DataFrame, p: str) -> DataFrame:
    """(s, o): o is reachable from s over one or more p; a node on a cycle reaches itself."""
    edges = pattern(graph, "?name", p, "?parent").distinct()
    pairs = closure(edges)
    back = edges.select(F.col("parent").alias("name"), F.col("name").alias("ancestor")).join(pairs, ["name", "ancestor"], "left_semi").select(F.col("ancestor").alias("s"), F.col("ancestor").alias("o"))
    return pairs.where("depth > 0").select(F.col("name").alias("s"), F.col("ancestor").alias("o")).union(back).distinct()


def ask(bindings: DataFrame) -> DataFrame:
    """One row: whether there is any binding."""
    return bindings.limit(1).agg((F.count("*") > 0).alias("answer"))


def added_removed(before: DataFrame, after: DataFrame, key: str = "s") -> DataFrame:
    """(key, change) of subjects that one graph alone has."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    return b.join(a, key, "left_anti").withColumn("change", F.lit("added")).union(a.join(b, key, "left_anti").withColumn("change", F.lit("removed")))


def modified(before: DataFrame, after: DataFrame) -> DataFrame:
    """(s, p, o, change) of facts that differ, for subjects of both graphs."""
    facts = ["s", "p", "o"]
    a, b = before.select(*facts).distinct(), after.select(*facts).distinct()
    change = b.join(a, facts, "left_anti").withColumn("change", F.lit("added")).union(a.join(b, facts, "left_anti").withColumn("change", F.lit("removed")))
    common = a.select("s").distinct().join(b.select("s").distinct(), "s")
    return change.join(common, "s", "left_semi")


def signatures(graph: DataFrame, *predicates: str) -> DataFrame:
    """(s, signature): a subject's facts of these predicates as one sorted text, whatever its own name."""
    rows = graph.where(F.col("p").isin(*predicates)) if predicates else graph
    return rows.groupBy("s").agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "p", "o"))), "|").alias("signature"))


def canonical(graph: DataFrame) -> DataFrame:
    """The graph with blank nodes named by what they say: nested ones first, however deep, one round a level; then those on
    cycles, or before one, by their place in what hangs together (`_cyclic`). Graphs that differ in the names of blank nodes
    alone become equal. Blank nodes that say the same are one, unless a cycle holds both."""
    needs_checkpoints(graph.sparkSession)
    named = graph
    while True:
        inner = named.where("s_kind = 'bnode'").join(named.where("o_kind = 'bnode' AND s_kind = 'bnode'").select("s").distinct(), "s", "left_anti")
        names = inner.groupBy("s").agg(F.concat(F.lit("_:"), F.sha2(F.array_join(F.array_sort(F.collect_set(F.concat_ws("=", "p", "o"))), "|"), 256)).alias("name")).checkpoint()
        if names.isEmpty():
            break
        named = _renamed(named, names).checkpoint()
    if not named.where("s_kind = 'bnode'").isEmpty():
        named = _renamed(named, _cyclic(named))
    return named.select("s", "p", "o", "s_kind", "o_kind").distinct()


def _renamed(graph: DataFrame, names: DataFrame) -> DataFrame:
    """Subjects and objects that have a name (s, name) take it, and are no blank nodes from then on."""
    done = lambda kind: F.when(F.col("name").isNotNull(), "named").otherwise(F.col(kind))
    graph = graph.join(names, "s", "left").withColumn("s_kind", done("s_kind")).withColumn("s", F.coalesce("name", "s")).drop("name")
    return graph.join(names.withColumnRenamed("s", "o"), "o", "left").withColumn("o_kind", done("o_kind")).withColumn("o", F.coalesce("name", "o")).drop("name")


#: Steps of a search for what hangs together between two tables; facts of one such part, and ways to tell its nodes apart, at most.
STEPS, FACTS, WAYS = 3, 1_000_000, 10_000


def _cyclic(graph: DataFrame) -> DataFrame:
    """(s, name) of blank nodes that lead to cycles. Parts that hang together over blank nodes are found by least labels and
    named part by part, each in one task (`_told_apart`); a part of more than FACTS facts is an error."""
    blank = graph.where("s_kind = 'bnode' OR o_kind = 'bnode'").select("s", "p", "o", "s_kind", "o_kind").distinct().checkpoint()
    both = blank.where("s_kind = 'bnode' AND o_kind = 'bnode'")
    near = both.select(F.col("s").alias("node"), F.col("o").alias("other")).union(both.select("o", "s")).distinct().checkpoint()
    label = blank.where("s_kind = 'bnode'").select(F.col("s").alias("node")).union(blank.where("o_kind = 'bnode'").select("o")).distinct().withColumn("part", F.col("node"))
    before = None
    while True:
        for _ in range(STEPS):
            least = near.join(label.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("part").alias("least"))
            label = label.join(least, "node", "left").select("node", F.least("part", "least").alias("part"))
        label = label.checkpoint()
        after = label.agg(F.sum(F.pmod(F.xxhash64("node", "part"), F.lit(1 << 40)))).first()[0]
        if after == before:
            break
        before = after
    own = F.when(F.col("s_kind") == "bnode", F.col("s")).otherwise(F.col("o"))
    parted = blank.withColumn("node", own).join(label, "node").drop("node")
    largest = parted.groupBy("part").count().agg(F.max("count")).first()[0]
    if largest > FACTS:
        raise ValueError(f"{largest} facts hang together over blank nodes")

    def run(part: pd.DataFrame) -> pd.DataFrame:
        names = _told_apart([(s if sk == "bnode" else None, s, p, o if ok == "bnode" else None, o, ok) for s, p, o, sk, ok in part[["s", "p", "o", "s_kind", "o_kind"]].itertuples(index=False)])
        return pd.DataFrame(list(names.items()), columns=["s", "name"])

    return parted.groupBy("part").applyInPandas(run, "s string, name string")


def _told_apart(facts: list[tuple]) -> dict[str, str]:
    """Names of a part's blank nodes that do not depend on their own ones.

    Every node has a colour, refined by the predicates, directions and colours or terms around it until no class splits any
    more. While nodes share a colour, the smallest such class is followed in as many ways as it has nodes, another one set
    apart in each; of all ways the one with the least description counts. Nodes that can be exchanged give equal
    descriptions. Raises above WAYS ways: such symmetry has no cheap name.
    """
    digest = lambda *x: sha256("\x00".join(x).encode()).hexdigest()
    sides: dict[str, list[tuple]] = defaultdict(list)
    for s_node, s, p, o_node, o, kind in facts:
        if s_node is not None:
            sides[s_node].append((f">{p}", o_node, f"{kind}={o}"))
        if o_node is not None:
            sides[o_node].append((f"<{p}", s_node, f"={s}"))

    def refined(colour: dict[str, str]) -> dict[str, str]:
        classes = len(set(colour.values()))
        while True:
            colour = {n: digest(colour[n], *sorted(f"{p} {colour[other] if other is not None else term}" for p, other, term in around)) for n, around in sides.items()}
            if (now := len(set(colour.values()))) == classes:
                return colour
            classes = now

    ways, best, open_ways = 0, None, [refined(dict.fromkeys(sides, ""))]
    while open_ways:
        colour = open_ways.pop()
        of: dict[str, list[str]] = defaultdict(list)
        for n, c in colour.items():
            of[c].append(n)
        tied = [(len(x), c) for c, x in of.items() if len(x) > 1]
        if tied:
            ways += min(tied)[0]
            if ways > WAYS:
                raise ValueError(f"more than {WAYS} ways to tell blank nodes apart that look alike")
            open_ways += [refined(colour | {n: digest("apart", colour[n])}) for n in of[min(tied)[1]]]
            continue
        shown = digest(*sorted(f"{colour[a] if a is not None else s} {p} {colour[b] if b is not None else kind + '=' + o}" for a, s, p, b, o, kind in facts))
        if best is None or shown < best[0]:
            best = shown, colour
    return {n: f"_:{digest(best[0], c)}" for n, c in best[1].items()}


def count_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row (before, after, change): distinct facts of two graphs, and by how many they differ."""
    facts = lambda g, side: g.select("s", "p", "o").distinct().select(F.lit(side).alias("side"))
    n = lambda side: F.count_if(F.col("side") == side)
    return facts(before, "before").union(facts(after, "after")).agg(n("before").alias("before"), n("after").alias("after"), (n("after") - n("before")).alias("change"))


def kinds(graph: DataFrame, priority: dict[str, Column]) -> DataFrame:
    """(kind, n): subjects counted under the first kind whose test any of their facts meets."""
    names = list(priority)
    best = F.min(reduce(lambda rest, i: F.when(priority[names[i]], i).otherwise(rest), reversed(range(len(names))), F.lit(len(names))))
    of = graph.groupBy("s").agg(best.alias("k"))
    return of.groupBy(F.element_at(F.array(*[F.lit(n) for n in [*names, "other"]]), F.col("k") + 1).alias("kind")).agg(F.count("*").alias("n"))


def model_triples(items: DataFrame) -> DataFrame:
    """A model as triples: classes with parents and slots, slots with ranges, vocabularies with values."""
    from tesserae.sources import model

    of = triples(model.classes(items), F.col("name"), {"type": F.lit("Class"), "subClassOf": F.col("is_a"), "description": F.col("description")}, {"type": "iri", "subClassOf": "iri"})
    used = triples(items.where("kind IN ('class_slot', 'attribute')"), F.col("name"), {"slot": F.col("key")}, {"slot": "iri"})
    slots = model.slots(items)
    ranges = F.array_compact(F.array_append(F.coalesce(F.transform("def.any_of", lambda x: x["range"]), F.array().cast("array<string>")), F.col("def.range")))
    typed = triples(slots, F.col("slot"), {"type": F.lit("Slot")}, {"type": "iri"})
    ranged = triples(slots.select("slot", F.explode(ranges).alias("range")), F.col("slot"), {"range": F.col("range")}, {"range": "iri"})
    words = triples(model.enum_values(items), F.col("enum"), {"value": F.col("label")})
    return of.unionByName(used).unionByName(typed).unionByName(ranged).unionByName(words).distinct()


def inferred(graph: DataFrame, sub: str = "subClassOf", type: str = "type") -> DataFrame:
    """The graph with what its class hierarchy entails: subclasses of ancestors, types of ancestor classes."""
    above = path_plus(graph, sub)
    classes = above.select("s", F.lit(sub).alias("p"), "o")
    types = pattern(graph, "?s", type, "?c").join(above.withColumnRenamed("s", "c"), "c").select("s", F.lit(type).alias("p"), "o")
    more = classes.union(types).select("s", "p", "o", F.lit("iri").alias("s_kind"), F.lit("iri").alias("o_kind"))
    return graph.select("s", "p", "o", "s_kind", "o_kind").union(more).distinct()


#: What a class, or a vocabulary, has below it: each a blank node that says of what, at which place, and what it sets.
MEMBERS = ("class_slot", "attribute", "usage", "rule", "value")


def model_graph(items: DataFrame) -> DataFrame:
    """A model with all it says as triples (s, p, o, s_kind, o_kind, datatype). Classes, slots and vocabularies are named by
    kind and name; their members are blank nodes. Texts are plain literals, other values JSON of datatype `json`."""
    top = ~F.col("kind").isin(*MEMBERS)
    own = F.when(top, F.concat_ws("/", "kind", "name")).otherwise(F.concat(F.lit("_:"), F.sha2(F.concat_ws("\x00", "kind", "name", "key", F.col("ord").cast("string")), 256)))
    rows = items.where("kind <> 'error'").select(own.alias("s"), F.when(top, "iri").otherwise("bnode").alias("s_kind"), "kind", "name", "key", "ord", F.try_parse_json("body").alias("body"))
    said = lambda p, o, kind="literal", datatype=None: F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(kind).alias("o_kind"), F.lit(datatype).cast("string").alias("datatype"))
    about = F.array(said("type", F.col("kind"), "iri"), said("place", F.col("ord"), datatype="json"), said("of", F.col("key")), said("name", F.when(F.col("s_kind") == "iri", F.col("name"))))
    facts = rows.select("s", "s_kind", F.explode(about).alias("f")).where("f.o IS NOT NULL").select("s", "f.p", "f.o", "s_kind", "f.o_kind", "f.datatype")
    owner = F.when(F.col("kind") == "value", F.concat(F.lit("enum/"), "name")).otherwise(F.concat(F.lit("class/"), "name"))
    members = rows.where("s_kind = 'bnode'").select(owner.alias("s"), F.lit("member").alias("p"), F.col("s").alias("o"), F.lit("iri").alias("s_kind"), F.lit("bnode").alias("o_kind"), F.lit(None).cast("string").alias("datatype"))
    text = F.col("set")["kind"] == "STRING"
    each = F.transform(F.map_entries(F.try_variant_get("body", "$", "map<string,variant>")), lambda e: F.struct(e["key"].alias("p"), F.schema_of_variant(e["value"]).alias("kind"), F.try_variant_get(e["value"], "$", "string").alias("text"), F.to_json(e["value"]).alias("json")))
    sets = rows.select("s", "s_kind", F.explode(each).alias("set")).select("s", F.concat(F.lit("set/"), "set.p").alias("p"), F.when(text, F.col("set.text")).otherwise(F.coalesce("set.json", F.lit("null"))).alias("o"), "s_kind", F.lit("literal").alias("o_kind"), F.when(~text, "json").alias("datatype"))
    return facts.unionByName(members).unionByName(sets)


def model_items(graph: DataFrame, file: str = "graph") -> DataFrame:
    """The declarations that a graph describes (`model_graph`), as the model reader gives them: what compiling takes. Members are
    found through their owners; blank nodes may have any names. What is said twice counts once."""
    facts = graph.select("s", "p", "o", "datatype").distinct()
    quoted = F.regexp_extract(F.to_json(F.array("o")), r"(?s)^\[(.*)\]$", 1)
    member = F.concat(F.to_json(F.array(F.substring_index("p", "/", -1))), F.lit(":"), F.when(F.col("datatype") == "json", F.col("o")).otherwise(quoted))
    member = F.regexp_replace(member, r"^\[(\"(?:[^\"\\]|\\.)*\")\]", "$1")
    one = lambda p: F.max(F.when(F.col("p") == p, F.col("o")))
    body = F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("p").startswith("set/"), member))), ","), F.lit("}"))
    nodes = facts.groupBy("s").agg(one("type").alias("kind"), one("name").alias("own"), one("of").alias("key"), one("place").cast("int").alias("ord"), body.alias("body"))
    owners = facts.where("p = 'member'").select(F.col("o").alias("s"), F.col("s").alias("owner"))
    owned = nodes.join(owners, "s", "left").join(nodes.select(F.col("s").alias("owner"), F.col("own").alias("owned_by")), "owner", "left")
    needs_checkpoints(graph.sparkSession)
    # compiling reads a model many times
    return owned.where("kind IS NOT NULL").select("kind", F.coalesce("own", "owned_by").alias("name"), "key", "ord", "body", F.lit(file).alias("file")).checkpoint()
