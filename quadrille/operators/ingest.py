"""Triples into a property graph: route, name, type, merge.

Everything is one lazy plan over the triples but for two small driver steps: the new namespaces (a vocabulary) get
their prefixes in document order, and the counters of the result are one aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Catalog, GraphConfig, ParserConfig
from ..functions import iri, literals
from ..functions.iri import _prefix_map
from ..model import RESOURCE, TYPE, XSD, Graph
from .closure import settled

BNODE = "bnode://"


@dataclass
class ImportResult:
    terminationStatus: str = "OK"
    triplesLoaded: int = 0
    triplesParsed: int = 0
    namespaces: dict[str, str] = field(default_factory=dict)
    extraInfo: str = ""
    callParams: dict = field(default_factory=dict)
    graph: Graph | None = None


def _bnode(c: Column) -> Column:
    return F.when(c.startswith("_:"), F.concat(F.lit(BNODE), F.substring(c, 3, 1 << 20))).otherwise(c)


def name_of(c: Column, catalog: Catalog, kind: str) -> Column:
    """The stored name of a vocabulary IRI; kind is label, rel or prop."""
    config = catalog.need()
    mode = config.handleVocabUris
    if mode == "KEEP":
        return c
    if mode in ("SHORTEN", "SHORTEN_STRICT"):
        return iri.shorten(c, catalog.prefixes.all())
    local = iri.local_name(c)
    if config.applyNaming:
        first = lambda up: F.concat((F.upper if up else F.lower)(F.substring(local, 1, 1)), F.substring(local, 2, 1 << 20))
        local = F.upper(local) if kind == "rel" else first(kind == "label")
    if mode == "MAP":
        return F.coalesce(F.try_element_at(_prefix_map(catalog.mappings.name_of()), c), local)
    return local


def allocate_prefixes(triples: DataFrame, catalog: Catalog) -> None:
    """Prefixes for the namespaces of predicates and types, by first appearance."""
    config = catalog.need()
    if config.handleVocabUris not in ("SHORTEN", "SHORTEN_STRICT"):
        return
    terms = triples.select(F.posexplode(F.array(F.col("predicate"), F.when((F.col("predicate") == TYPE) & ~F.col("isLiteral"), F.col("object")))).alias("place", "iri"), "ord").where("iri is not null")
    found = terms.groupBy(iri.namespace("iri").alias("ns")).agg(F.min(F.struct("ord", "place")).alias("at")).where("ns is not null").orderBy("at").collect()  # namespaces of the vocabulary
    new = [r.ns for r in found if catalog.prefixes.prefix_of(r.ns) is None]
    if new and config.handleVocabUris == "SHORTEN_STRICT":
        raise ValueError(f"Prefix Undefined: no prefix is defined for <{new[0]}>")
    catalog.prefixes.allocate(new)


def mapped(triples: DataFrame, catalog: Catalog, parser: ParserConfig | None = None) -> DataFrame:
    """Triples with their kind (label, prop, rel, relprop or null for none) and names and stored values.

    kind, uri, name, dst, graph, ord, type, lex, lang, datatype, src, rel. Blank nodes become ``bnode://`` IRIs.
    """
    config, parser = catalog.need(), parser or ParserConfig()
    t = triples
    if parser.predicateExclusionList:
        t = t.where(~F.col("predicate").isin(list(parser.predicateExclusionList)))
    lit, is_type, star = F.col("isLiteral"), F.col("predicate") == TYPE, F.col("subjectSPO").isNotNull()
    speaks = F.lit(True) if parser.languageFilter is None else F.col("literalLang").isNull() | (F.col("literalLang") == parser.languageFilter)
    triple_object = ~lit & F.col("object").startswith("<< ")
    kind = F.when(lit & ~speaks, None).when(star & lit & (F.col("subjectSPO")[1] != TYPE), "relprop").when(star | triple_object, None).when(lit, "prop").when(is_type & F.lit(config.handleRDFTypes != "NODES"), "label").otherwise("rel")
    t = t.withColumn("kind", kind).where("kind is not null")
    stored = literals.stored_type("literalType", "object")
    lex = literals.canonical(stored, "object")
    custom = ~F.coalesce(F.col("literalType"), F.lit(XSD + "string")).isin(XSD + "string", literals.LANG_STRING, literals.WKT, *(XSD + x for x in (*literals.LONGS, *literals.DOUBLES, "boolean", "date", "dateTime")))
    if config.keepCustomDataTypes and config.is_rdf:
        wanted = F.col("predicate").isin(list(config.customDataTypePropList)) if config.customDataTypePropList is not None else F.lit(True)
        kept_type = F.when(custom & wanted, F.col("literalType"))
    else:
        kept_type = F.lit(None).cast("string")
    p = F.col("predicate")
    label_of = name_of(F.col("object"), catalog, "label")
    out = t.select(
        "kind", _bnode(F.col("subject")).alias("uri"),
        F.when(F.col("kind") == "label", label_of).when(F.col("kind") == "rel", name_of(p, catalog, "rel")).otherwise(name_of(p, catalog, "prop")).alias("name"),
        F.when(~lit, _bnode(F.col("object"))).alias("dst"), "graph", "ord",
        F.when(lit, stored).alias("type"), F.when(lit, lex).alias("lex"),
        F.when(lit & F.lit(config.keepLangTag), F.col("literalLang")).alias("lang"), F.when(lit, kept_type).alias("datatype"),
        F.when(F.col("kind") == "relprop", _bnode(F.col("subjectSPO")[0])).alias("src"),
        F.when(F.col("kind") == "relprop", name_of(F.col("subjectSPO")[1], catalog, "rel")).alias("rel"),
        F.when(F.col("kind") == "relprop", _bnode(F.col("subjectSPO")[2])).alias("to"), "predicate", F.col("object").alias("iri"),
    )
    return out


def _multi(config: GraphConfig) -> Column:
    """Whether a property keeps all its values."""
    if config.handleMultival != "ARRAY":
        return F.lit(False)
    return F.lit(True) if config.multivalPropList is None else F.col("predicate").isin(list(config.multivalPropList))


def settle_values(values: DataFrame, keys: list[str], config: GraphConfig, strict: bool = True) -> DataFrame:
    """One value a key, the last one, or a set of values of one type.

    The first value fixes the type; values of another are dropped if ``strict``, else all become strings with their
    datatype behind.
    """
    v = values.withColumn("__multi", _multi(config))
    last = v.where(~F.col("__multi")).groupBy(*keys).agg(F.max_by(F.struct("ord", "type", "lex", "lang", "datatype"), "ord").alias("v")).select(*keys, "v.*")
    w = Window.partitionBy(*keys).orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    many = v.where("__multi").withColumn("__first", F.first("type").over(w))
    if strict:
        many = many.where(F.col("type") == F.col("__first"))
    else:
        mixed = F.max(F.col("type") != F.col("__first")).over(w)
        dt = F.coalesce(literals.datatype_of("type"), F.lit(XSD + "string"))
        said = F.when(F.col("type") == "string", F.col("lex")).otherwise(F.concat("lex", F.lit("^^xsd__"), iri.local_name(dt)))
        many = many.withColumn("__mixed", mixed).withColumn("lex", F.when(F.col("__mixed") & (F.col("type") != F.col("__first")), said).otherwise(F.col("lex"))).withColumn("type", F.when(F.col("__mixed"), "string").otherwise(F.col("type")))
    many = many.groupBy(*keys, "type", "lex", F.col("lang"), F.col("datatype")).agg(F.min("ord").alias("ord")).select(*keys, "ord", "type", "lex", "lang", "datatype")
    return last.unionByName(many)


def build(rows: DataFrame, catalog: Catalog, parser: ParserConfig | None = None) -> Graph:
    """The graph of mapped rows alone."""
    config, parser = catalog.need(), parser or ParserConfig()
    both = config.handleRDFTypes == "LABELS_AND_NODES"
    labels = rows.where("kind = 'label'").select("uri", "graph", F.col("name").alias("label"))
    rel = rows.where("kind = 'rel'")
    type_edges = rows.where("kind = 'label'").select(F.col("uri").alias("src"), name_of(F.lit(TYPE), catalog, "rel").alias("type"), F.col("iri").alias("dst"), "graph")
    edges = rel.select(F.col("uri").alias("src"), F.col("name").alias("type"), "dst", "graph")
    star = rows.where("kind = 'relprop'")
    edges = edges.unionByName(star.select("src", F.col("rel").alias("type"), F.col("to").alias("dst"), "graph"))
    if both:
        edges = edges.unionByName(type_edges)
    edges = edges.distinct()
    props = settle_values(rows.where("kind = 'prop'").withColumnRenamed("name", "key"), ["uri", "graph", "key"], config, parser.strictDataTypeCheck).select("uri", "graph", "key", "ord", "type", "lex", "lang", "datatype")
    ep = settle_values(star.withColumnRenamed("name", "key").withColumnRenamed("rel", "type_").drop("dst").withColumnRenamed("to", "dst"), ["src", "type_", "dst", "graph", "key"], config, parser.strictDataTypeCheck).select("src", "type_", "dst", "graph", "key", "ord", "type", "lex", "lang", "datatype")
    every = rows.where("kind in ('label', 'prop', 'rel')").select("uri", "graph").unionByName(edges.select(F.col("src").alias("uri"), "graph")).unionByName(edges.select(F.col("dst").alias("uri"), "graph"))
    nodes = every.withColumn("label", F.lit(RESOURCE)).unionByName(labels).groupBy("uri", "graph").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    return Graph(nodes, props, edges, ep)


def merge(old: Graph, new: Graph, config: GraphConfig, strict: bool = True) -> Graph:
    """``new`` on top of ``old``: labels and edges unite, single values are replaced, sets are united."""
    nodes = old.nodes.unionByName(new.nodes).groupBy("uri", "graph").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("labels"))

    def values(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
        shift = F.lit(1 << 56)
        both = a.unionByName(b.withColumn("ord", F.col("ord") + shift))
        if config.handleMultival == "ARRAY":
            both = both.withColumn("predicate", F.col("key"))
            made = settle_values(both, keys, config, strict)
        else:
            made = both.groupBy(*keys).agg(F.max_by(F.struct("ord", "type", "lex", "lang", "datatype"), "ord").alias("v")).select(*keys, "v.*")
        return made.withColumn("ord", F.col("ord") % shift).select(a.columns)

    return Graph(nodes, values(old.props, new.props, ["uri", "graph", "key"]), old.edges.unionByName(new.edges).distinct(), values(old.edge_props, new.edge_props, ["src", "type_", "dst", "graph", "key"]))


def load(triples: DataFrame, catalog: Catalog, parser: ParserConfig | None = None, into: Graph | None = None) -> ImportResult:
    """Imports triples; the result has the counters and the graph."""
    parser = parser or ParserConfig()
    allocate_prefixes(triples, catalog)
    rows = settled(mapped(triples, catalog, parser))
    graph = build(rows, catalog, parser)
    values = rows.where("kind = 'prop'")
    config = catalog.need()
    dropped = 0
    if config.handleMultival == "ARRAY" and parser.strictDataTypeCheck:
        w = Window.partitionBy("uri", "graph", "name").orderBy("ord")
        dropped = values.where(_multi(config)).withColumn("first", F.first("type").over(w)).where("type <> first").count()
    loaded = rows.count() - dropped
    parsed = triples.count()
    if into is not None:
        graph = merge(into, graph, config, parser.strictDataTypeCheck)
    return ImportResult("OK", loaded, parsed, catalog.prefixes.all() if config.handleVocabUris.startswith("SHORTEN") else {}, "", {}, graph)


def preview(triples: DataFrame, catalog: Catalog, parser: ParserConfig | None = None) -> Graph:
    """The graph of the first ``limit`` mapped statements, without a load."""
    parser = parser or ParserConfig()
    allocate_prefixes(triples, catalog)
    rows = mapped(triples, catalog, parser).orderBy("ord").limit(parser.limit)
    return build(settled(rows), catalog, parser)
