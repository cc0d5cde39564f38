"""A graph as triples: one lazy view, on which every pattern is a filter.

``triples_view`` unites labels, properties, edges and edge properties; Catalyst pushes what a pattern binds into
each branch, down to the Parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Catalog
from ..functions.iri import SHORT, _prefix_map
from ..functions.literals import LANG_STRING, XSD, canonical, datatype_of
from ..model import OWL, RDFS, RESOURCE, TYPE, Graph

COLUMNS = ("subject", "predicate", "object", "isLiteral", "literalType", "literalLang", "subjectSPO")


def full_name(name: Column, catalog: Catalog) -> Column:
    """The IRI of a stored name: by its prefix or as it is in RDF graphs, by its mapping in others; else under the base."""
    base = catalog.config.baseSchemaNamespace if catalog.config else catalog_base()
    under = F.concat(F.lit(base), name)
    if catalog.config is not None and catalog.config.is_rdf:
        prefix, local = F.regexp_extract(name, SHORT, 1), F.regexp_extract(name, SHORT, 2)
        ns = F.try_element_at(_prefix_map(catalog.prefixes.all()), prefix)
        known = F.coalesce(F.concat(ns, local), F.raise_error(F.concat(F.lit("Prefix Undefined: "), prefix)).cast("string"))
        return F.when(name.rlike(r"^\w+:"), name).when(name.rlike(SHORT), known).otherwise(under)
    return F.coalesce(F.try_element_at(_prefix_map(catalog.mappings.iri_of), name), under)


def catalog_base() -> str:
    from ..model import BASE

    return BASE


def _mapped(frame: DataFrame, name: str, catalog: Catalog, only: bool) -> DataFrame:
    return frame.where(F.col(name).isin(list(catalog.mappings.iri_of))) if only else frame


def _row(s, p, o, literal=False, kind=None, lang=None, spo=None) -> list[Column]:
    null = F.lit(None).cast("string")
    return [s.alias("subject"), p.alias("predicate"), o.alias("object"), F.lit(literal).alias("isLiteral"), (null if kind is None else kind).alias("literalType"), (null if lang is None else lang).alias("literalLang"), (F.lit(None).cast("array<string>") if spo is None else spo).alias("subjectSPO")]


def _value() -> tuple[Column, Column, Column]:
    kind = F.coalesce(F.col("datatype"), F.when(F.col("lang").isNotNull(), F.lit(LANG_STRING)), datatype_of("type"), F.lit(XSD + "string"))
    return F.col("lex"), kind, F.col("lang")


def triples_view(graph: Graph, catalog: Catalog | None = None, mapped_only: bool = False, rel_props: bool = True, with_graph: bool = False) -> DataFrame:
    """All statements of a graph; each once, as far as the tables hold each fact once."""
    catalog = catalog or Catalog()
    g = [F.col("graph")] if with_graph else []
    labels = _mapped(graph.nodes.select("uri", "graph", F.explode("labels").alias("label")).where(F.col("label") != RESOURCE), "label", catalog, mapped_only)
    parts = [labels.select(*_row(F.col("uri"), F.lit(TYPE), full_name(F.col("label"), catalog)), *g)]
    lex, kind, lang = _value()
    parts.append(_mapped(graph.props, "key", catalog, mapped_only).select(*_row(F.col("uri"), full_name(F.col("key"), catalog), lex, True, kind, lang), *g))
    edges = _mapped(graph.edges, "type", catalog, mapped_only)
    parts.append(edges.select(*_row(F.col("src"), full_name(F.col("type"), catalog), F.col("dst")), *g))
    if rel_props:
        ep = _mapped(_mapped(graph.edge_props, "key", catalog, mapped_only), "type_", catalog, mapped_only)
        spo = F.array(F.col("src"), full_name(F.col("type_"), catalog), F.col("dst"))
        parts.append(ep.select(*_row(F.concat(F.lit("<< "), F.array_join(spo, " "), F.lit(" >>")), full_name(F.col("key"), catalog), lex, True, kind, lang, spo), *g))
    return reduce(DataFrame.unionByName, parts)


def spo(triples: DataFrame, subject: str | None = None, predicate: str | None = None, object_: str | None = None, is_literal: bool = False, literal_type: str | None = None, literal_lang: str | None = None) -> DataFrame:
    """The triples that match what is given; the type (string where none is said) and language count for literals."""
    out = triples
    if subject is not None:
        out = out.where(F.col("subject") == subject)
    if predicate is not None:
        out = out.where(F.col("predicate") == predicate)
    if object_ is not None:
        out = out.where(F.col("isLiteral") == is_literal)
        if not is_literal:
            return out.where(F.col("object") == object_)
        kind = LANG_STRING if literal_lang else literal_type or XSD + "string"
        same = F.col("object") == object_
        if kind in {XSD + k for k in ("long", "int", "integer", "decimal", "float", "double", "boolean")}:
            stored = "boolean" if kind.endswith("boolean") else "long" if kind[len(XSD) :] in ("long", "int", "integer") else "double"
            same = F.col("object") == canonical(F.lit(stored), F.lit(object_))
            kinds = [XSD + k for k in {"long": ("long", "int", "integer"), "double": ("double", "float", "decimal"), "boolean": ("boolean",)}[stored]]
            return out.where(same & F.col("literalType").isin(kinds))
        out = out.where(same & (F.col("literalType") == kind))
        if literal_lang:
            out = out.where(F.col("literalLang") == literal_lang)
    return out


def describe(graph: Graph, uri: str, catalog: Catalog | None = None, named: str | None = None, context: bool = True, mapped_only: bool = False) -> DataFrame:
    """A node's own statements and, with context, those of its edges either way."""
    view = triples_view(graph, catalog, mapped_only, with_graph=True)
    if named is not None:
        view = view.where(F.col("graph") == named)
    own = (F.col("subject") == uri) & (F.col("isLiteral") | (F.col("predicate") == TYPE))
    ways = F.col("subjectSPO").isNull() & ~F.col("isLiteral") & ((F.col("subject") == uri) | (F.col("object") == uri))
    star = (F.col("subjectSPO")[0] == uri) | (F.col("subjectSPO")[2] == uri)
    return view.where(own | (ways | F.coalesce(star, F.lit(False)) if context else F.lit(False))).select(*COLUMNS).distinct()


def find(graph: Graph, label: str, key: str, value: str, value_type: str | None = None, catalog: Catalog | None = None, context: bool = True, mapped_only: bool = False) -> DataFrame:
    """The statements of the nodes that have a label and a property value; INTEGER, FLOAT and BOOLEAN are compared as such."""
    stored = {"INTEGER": "long", "FLOAT": "double", "BOOLEAN": "boolean"}.get(value_type or "")
    want = canonical(F.lit(stored), F.lit(value)) if stored else F.lit(value)
    hit = (F.col("key") == key) & (F.col("lex") == want) & (F.col("type") == (stored or "string"))
    with_label = graph.nodes.where(F.array_contains("labels", label)).select("uri")
    focus = graph.props.where(hit).select("uri").distinct().join(with_label, "uri", "left_semi")
    view = triples_view(graph, catalog, mapped_only)
    own = view.where(F.col("isLiteral") | (F.col("predicate") == TYPE) | (F.lit(context) & F.col("subjectSPO").isNull())).join(focus.withColumnRenamed("uri", "subject"), "subject", "left_semi")
    if not context:
        return own.select(*COLUMNS).distinct()
    into = view.where(~F.col("isLiteral") & (F.col("predicate") != TYPE)).join(focus.withColumnRenamed("uri", "object"), "object", "left_semi")
    return own.select(*COLUMNS).unionByName(into.select(*COLUMNS)).distinct()


def export_elements(graph: Graph, nodes: DataFrame | None = None, edges: DataFrame | None = None, catalog: Catalog | None = None, mapped_only: bool = False, rel_props: bool = True) -> DataFrame:
    """Statements of the elements that a query returned: nodes (uri) and edges (src, type, dst)."""
    none = Graph.empty(graph.nodes.sparkSession)
    part = none
    if nodes is not None:
        ids = nodes.select("uri").distinct()
        part = part.with_(nodes=graph.nodes.join(ids, "uri", "left_semi"), props=graph.props.join(ids, "uri", "left_semi"))
    if edges is not None:
        ids = edges.select("src", "type", "dst").distinct()
        part = part.with_(edges=graph.edges.join(ids, ["src", "type", "dst"], "left_semi"), edge_props=graph.edge_props.join(ids.withColumnRenamed("type", "type_"), ["src", "type_", "dst"], "left_semi"))
    return triples_view(part, catalog, mapped_only, rel_props).distinct()


def export_sql(graph: Graph, query: str, catalog: Catalog | None = None, **options) -> DataFrame:
    """As ``export_elements`` for Spark SQL over the views nodes, props, edges and edge_props.

    The query returns a column uri for nodes, or src, type and dst for edges; both may be there.
    """
    for name in ("nodes", "props", "edges", "edge_props"):
        getattr(graph, name).createOrReplaceTempView(name)
    got = graph.nodes.sparkSession.sql(query)
    nodes = got.select("uri") if "uri" in got.columns else None
    edges = got.select("src", "type", "dst") if {"src", "type", "dst"} <= set(got.columns) else None
    return export_elements(graph, nodes, edges, catalog, **options)


def implicit_ontology(graph: Graph, catalog: Catalog | None = None) -> DataFrame:
    """(subject, predicate, object): classes, object and datatype properties with domains and ranges, as the data show them."""
    catalog = catalog or Catalog()
    name = lambda c: full_name(F.col(c), catalog)
    triple = lambda s, p, o: [s.alias("subject"), F.lit(p).alias("predicate"), o.alias("object")]
    labels = graph.nodes.select("uri", F.explode(F.array_except("labels", F.array(F.lit(RESOURCE)))).alias("label"))
    first = graph.nodes.select("uri", F.try_element_at(F.array_except("labels", F.array(F.lit(RESOURCE))), F.lit(1)).alias("label")).where("label is not null")
    classes = labels.select("label").distinct().select(*triple(name("label"), TYPE, F.lit(OWL + "Class")))
    ends = graph.edges.join(first.select(F.col("uri").alias("src"), F.col("label").alias("from")), "src", "left").join(first.select(F.col("uri").alias("dst"), F.col("label").alias("to")), "dst", "left").select("type", "from", "to").distinct()
    rels = [ends.select("type").distinct().select(*triple(name("type"), TYPE, F.lit(OWL + "ObjectProperty"))), ends.where("from is not null").select("type", "from").distinct().select(*triple(name("type"), RDFS + "domain", name("from"))), ends.where("to is not null").select("type", "to").distinct().select(*triple(name("type"), RDFS + "range", name("to")))]
    keys = graph.props.join(first, "uri", "left").select("key", "type", "label").distinct()
    props = [keys.select("key").distinct().select(*triple(name("key"), TYPE, F.lit(OWL + "DatatypeProperty"))), keys.where("label is not null").select("key", "label").distinct().select(*triple(name("key"), RDFS + "domain", name("label"))), keys.select("key", "type").distinct().select(*triple(name("key"), RDFS + "range", F.coalesce(datatype_of("type"), F.lit(XSD + "string"))))]
    return reduce(DataFrame.unionByName, [classes, *rels, *props]).distinct()


def explicit_ontology(graph: Graph, catalog: Catalog | None = None) -> DataFrame:
    """DOMAIN, RANGE, SCO and SPO edges between named classes and properties, as RDFS statements."""
    from ..config import GraphConfig

    catalog = catalog or Catalog()
    c = catalog.config or GraphConfig()
    terms = {c.domainRel: RDFS + "domain", c.rangeRel: RDFS + "range", c.subClassOfRel: RDFS + "subClassOf", c.subPropertyOfRel: RDFS + "subPropertyOf"}
    named = graph.props.where(F.col("key").isin(c.classNamePropName, c.relNamePropName)).select("uri", F.col("lex").alias("name"))
    e = graph.edges.where(F.col("type").isin(list(terms)))
    e = e.join(named.select(F.col("uri").alias("src"), F.col("name").alias("from")), "src").join(named.select(F.col("uri").alias("dst"), F.col("name").alias("to")), "dst")
    return e.select(full_name(F.col("from"), catalog).alias("subject"), F.try_element_at(_prefix_map(terms), F.col("type")).alias("predicate"), full_name(F.col("to"), catalog).alias("object")).distinct()
