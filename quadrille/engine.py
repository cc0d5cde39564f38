"""The engine: a graph with its catalogue, and one method for each procedure, function and endpoint."""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Catalog, GraphConfig, GraphConfigError, ParserConfig, Prefixes, split_iri
from .model import RESOURCE, TYPE, XSD, Graph
from .operators import collect as _collect
from .operators import delete as _delete
from .operators import dimodel, export, infer, ingest, onto, shacl, similarity
from .operators.closure import settled
from .sources import readers, writers
from .sources.jsonld import json_tree
from .sources.terms import Literal, Quoted, statement

__version__ = "0.1.0"


class Engine:
    """State is a Graph of lazy tables and a small Catalog; ``save`` and ``load`` keep the graph as Parquet."""

    def __init__(self, spark: SparkSession, graph: Graph | None = None, catalog: Catalog | None = None):
        self.spark, self.graph, self.catalog = spark, graph or Graph.empty(spark), catalog or Catalog()

    def version(self) -> str:
        return __version__

    def ping(self) -> dict:
        return {"ping": "here!"}

    # --- catalogue --------------------------------------------------------------------------------------------

    def _only_empty(self, what: str) -> None:
        if not self.graph.is_empty():
            raise GraphConfigError(f"{what} needs an empty graph")

    def graphconfig_init(self, params: dict | None = None) -> DataFrame:
        self._only_empty("graphconfig_init")
        self.catalog.config = GraphConfig.of(params)
        return self.graphconfig_show()

    def graphconfig_set(self, params: dict, force: bool = False) -> DataFrame:
        if not force:
            self._only_empty("graphconfig_set")
        self.catalog.config = self.catalog.need().changed(params)
        return self.graphconfig_show()

    def graphconfig_show(self) -> DataFrame:
        return self.catalog.need().show(self.spark)

    def graphconfig_drop(self) -> None:
        self._only_empty("graphconfig_drop")
        self.catalog.config = None

    def nsprefixes_add(self, prefix: str, ns: str) -> DataFrame:
        self.catalog.prefixes.add(prefix, ns)
        return self.nsprefixes_list()

    def nsprefixes_remove(self, prefix: str) -> DataFrame:
        self._only_empty("nsprefixes_remove")
        self.catalog.prefixes.remove(prefix, {split_iri(x)[0] for x in self.catalog.mappings.iri_of.values()})
        return self.nsprefixes_list()

    def nsprefixes_remove_all(self) -> DataFrame:
        self._only_empty("nsprefixes_remove_all")
        self.catalog.prefixes = Prefixes()
        return self.nsprefixes_list()

    def nsprefixes_add_from_text(self, text: str) -> DataFrame:
        self.catalog.prefixes.add_from_text(text)
        return self.nsprefixes_list()

    def nsprefixes_list(self) -> DataFrame:
        return self.catalog.prefixes.list(self.spark)

    def mapping_add(self, iri: str, name: str) -> DataFrame:
        self.catalog.mappings.add(iri, name, self.catalog.prefixes)
        return self.mapping_list(name)

    def mapping_drop(self, name: str) -> bool:
        return self.catalog.mappings.drop(name)

    def mapping_drop_all(self, ns: str) -> int:
        return self.catalog.mappings.drop_all(ns)

    def mapping_list(self, text: str = "") -> DataFrame:
        return self.catalog.mappings.list(self.spark, self.catalog.prefixes, text)

    # --- sources ----------------------------------------------------------------------------------------------

    def _read(self, source: str, fmt: str, params: dict | None, inline: bool) -> tuple[DataFrame, ParserConfig]:
        parser = ParserConfig.of(params)
        if inline:
            return readers.inline(self.spark, source, fmt, parser), parser
        if urlparse(source).scheme in ("http", "https"):
            raise readers.ParseError("HTTP sources aren't read; put the file where Spark reads")
        return readers.read(self.spark, source, fmt, parser), parser

    def rdf_stream_fetch(self, path: str, fmt: str, params: dict | None = None) -> DataFrame:
        return readers.stream(*self._read(path, fmt, params, False))

    def rdf_stream_inline(self, text: str, fmt: str, params: dict | None = None) -> DataFrame:
        return readers.stream(*self._read(text, fmt, params, True))

    def _import(self, loader, source: str, fmt: str, params: dict | None, inline: bool, formats=readers.FORMATS) -> ingest.ImportResult:
        """A result with status KO and the reason, rather than an error, for what can't be read or loaded."""
        try:
            self.catalog.need()
            if readers.need_format(fmt) not in formats:
                raise readers.ParseError(f"{fmt} has no named graphs; use one of {', '.join(formats)}")
            triples, parser = self._read(source, fmt, params, inline)
            got = loader(settled(triples), self.catalog, parser)
        except Exception as e:  # the contract of the call: errors are rows
            return ingest.ImportResult("KO", extraInfo=str(e)[:1000], callParams=params or {})
        got.callParams = params or {}
        self.graph = ingest.merge(self.graph, got.graph, self.catalog.need(), parser.strictDataTypeCheck)
        return got

    def rdf_import_fetch(self, path: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(self._plain, path, fmt, params, False)

    def rdf_import_inline(self, text: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(self._plain, text, fmt, params, True)

    @staticmethod
    def _plain(triples, catalog, parser):
        return ingest.load(triples.withColumn("graph", F.lit(None).cast("string")), catalog, parser)

    def quadrdf_import_fetch(self, path: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(ingest.load, path, fmt, params, False, readers.QUAD_FORMATS)

    def quadrdf_import_inline(self, text: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(ingest.load, text, fmt, params, True, readers.QUAD_FORMATS)

    def onto_import_fetch(self, path: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(onto.load_ontology, path, fmt, params, False)

    def onto_import_inline(self, text: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(onto.load_ontology, text, fmt, params, True)

    def skos_import_fetch(self, path: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(onto.load_skos, path, fmt, params, False)

    def skos_import_inline(self, text: str, fmt: str, params: dict | None = None) -> ingest.ImportResult:
        return self._import(onto.load_skos, text, fmt, params, True)

    def rdf_preview_fetch(self, path: str, fmt: str, params: dict | None = None) -> Graph:
        t, parser = self._read(path, fmt, params, False)
        return ingest.preview(t, self._copy(), parser)

    def rdf_preview_inline(self, text: str, fmt: str, params: dict | None = None) -> Graph:
        t, parser = self._read(text, fmt, params, True)
        return ingest.preview(t, self._copy(), parser)

    def onto_preview_fetch(self, path: str, fmt: str, params: dict | None = None) -> Graph:
        t, parser = self._read(path, fmt, params, False)
        return onto.load_ontology(t.orderBy("ord").limit(parser.limit), self._copy(), parser).graph

    def onto_preview_inline(self, text: str, fmt: str, params: dict | None = None) -> Graph:
        t, parser = self._read(text, fmt, params, True)
        return onto.load_ontology(t.orderBy("ord").limit(parser.limit), self._copy(), parser).graph

    def _copy(self) -> Catalog:
        """A preview allocates prefixes of its own."""
        c = self.catalog
        return Catalog(c.need(), Prefixes(c.prefixes.own), c.mappings)

    def _delete(self, source: str, fmt: str, params: dict | None, inline: bool, quads: bool) -> _delete.DeleteResult:
        if quads and fmt not in readers.QUAD_FORMATS:
            raise readers.ParseError(f"{fmt} has no named graphs")
        t, parser = self._read(source, fmt, params, inline)
        if not quads:
            t = t.withColumn("graph", F.lit(None).cast("string"))
        got = _delete.delete(self.graph, t, self.catalog, parser)
        self.graph = got.graph
        return got

    def rdf_delete_fetch(self, path: str, fmt: str, params: dict | None = None):
        return self._delete(path, fmt, params, False, False)

    def rdf_delete_inline(self, text: str, fmt: str, params: dict | None = None):
        return self._delete(text, fmt, params, True, False)

    def quadrdf_delete_fetch(self, path: str, fmt: str, params: dict | None = None):
        return self._delete(path, fmt, params, False, True)

    def quadrdf_delete_inline(self, text: str, fmt: str, params: dict | None = None):
        return self._delete(text, fmt, params, True, True)

    # --- adding -----------------------------------------------------------------------------------------------

    def _full(self, name: str) -> str:
        """An IRI, the IRI of a short form, or a name under the base namespace."""
        if ":" in name:
            return name
        prefix, mark, local = name.partition("__")
        if mark:
            ns = self.catalog.prefixes.all().get(prefix)
            if ns is None:
                raise GraphConfigError(f"Prefix Undefined: {prefix}")
            return ns + local
        return self.catalog.need().baseSchemaNamespace + name

    def _add(self, statements: list) -> Graph:
        from .model import TRIPLES

        t = self.spark.createDataFrame([tuple(s) for s in statements], TRIPLES)
        got = ingest.load(t, self.catalog)
        self.graph = ingest.merge(self.graph, got.graph, self.catalog.need())
        return got.graph

    def _literal(self, p: dict) -> Literal:
        value = p["val"]
        kind = XSD + {bool: "boolean", int: "long", float: "double"}.get(type(value), "string")
        text = str(value).lower() if isinstance(value, bool) else str(value)
        return Literal(text, self._full(p["dt"]) if p.get("dt") else kind, p.get("lan"))

    def add_node(self, uri: str, types: list[str], props: list[dict] | None = None) -> Graph:
        rows = [(uri, TYPE, self._full(t)) for t in types] + [(uri, self._full(p["key"]), self._literal(p)) for p in props or []]
        return self._add([statement(s, p, o, None, i) for i, (s, p, o) in enumerate(rows)])

    def add_relationship_uris(self, start: str, rel: str, props: list[dict] | None, end: str) -> Graph:
        known = {r.uri for r in self.graph.nodes.where(F.col("uri").isin(start, end)).select("uri").distinct().collect()}
        if missing := {start, end} - known:
            raise ValueError(f"no such node: {', '.join(sorted(missing))}")
        q = Quoted(start, self._full(rel), end)
        rows = [(start, q.p, end)] + [(q, self._full(p["key"]), self._literal(p)) for p in props or []]
        return self._add([statement(s, p, o, None, i) for i, (s, p, o) in enumerate(rows)])

    def add_relationship_nodes(self, start: dict, rel: str, props: list[dict] | None, end: dict) -> Graph:
        """Ends are nodes: mappings with uri and labels."""
        for n in (start, end):
            if not n.get("uri") or RESOURCE not in n.get("labels", [RESOURCE]):
                raise ValueError("both ends must be resources with a uri")
        return self.add_relationship_uris(start["uri"], rel, props, end["uri"])

    def import_json_as_tree(self, node_uri: str | None, json: str, rel: str = "_jsonTree") -> Graph | None:
        made = json_tree(json, node_uri or f"graph://indiv#{uuid.uuid4()}", self._full(rel) if ":" in rel else rel)
        return self._add(made) if made else None

    # --- export and endpoints ---------------------------------------------------------------------------------

    def rdf_export_sql(self, query: str, mapped_only: bool = False, rel_props: bool = True) -> DataFrame:
        return export.export_sql(self.graph, query, self.catalog, mapped_only=mapped_only, rel_props=rel_props)

    def rdf_export_spo(self, subject=None, predicate=None, object_=None, is_literal=False, literal_type=None, literal_lang=None) -> DataFrame:
        return export.spo(export.triples_view(self.graph, self.catalog), subject, predicate, object_, is_literal, literal_type, literal_lang)

    def _document(self, triples: DataFrame, format_: str | None, accept: str | None) -> str:
        rows = [r.asDict() for r in triples.collect()]  # an answer to one request
        return writers.Document(rows, self.catalog.prefixes.all()).write(writers.negotiate(format_, accept))

    def describe(self, uri: str, graph_uri: str | None = None, exclude_context: bool = False, mapped_only: bool = False, format_: str | None = None, accept: str | None = None) -> str:
        return self._document(export.describe(self.graph, uri, self.catalog, graph_uri, not exclude_context, mapped_only), format_, accept)

    def find(self, label: str, key: str, value: str, value_type: str | None = None, exclude_context: bool = False, mapped_only: bool = False, format_: str | None = None, accept: str | None = None) -> str:
        return self._document(export.find(self.graph, label, key, value, value_type, self.catalog, not exclude_context, mapped_only), format_, accept)

    def export_query(self, query: str, mapped_only: bool = False, format_: str | None = None, accept: str | None = None) -> str:
        return self._document(self.rdf_export_sql(query, mapped_only), format_, accept)

    def onto(self, format_: str | None = None, accept: str | None = None) -> str:
        null = F.lit(None).cast("string")
        t = export.implicit_ontology(self.graph, self.catalog).select("subject", "predicate", "object", F.lit(False).alias("isLiteral"), null.alias("literalType"), null.alias("literalLang"), F.lit(None).cast("array<string>").alias("subjectSPO"))
        return self._document(t, format_, accept)

    def rdf_collect(self, triples: DataFrame, fmt: str = "nt", *keys: str) -> DataFrame:
        return _collect.collect(triples, fmt, *keys, prefixes=self.catalog.prefixes.all())

    # --- inference and similarity -----------------------------------------------------------------------------

    def _classes(self, label: str | None = None, rel: str | None = None, name: str | None = None) -> DataFrame:
        c = self.catalog.config or GraphConfig()
        return infer.hierarchy(self.graph, label or c.classLabel, rel or c.subClassOfRel, name or c.classNamePropName)

    def _named_links(self, rel: str, label: str) -> DataFrame:
        named = self.graph.props.where(F.col("key") == "name").select("uri", F.col("lex").alias("name"))
        of = self.graph.nodes.where(F.array_contains("labels", label)).select("uri").join(named, "uri")
        e = self.graph.edges.where(F.col("type") == rel)
        return e.join(of.select(F.col("uri").alias("src"), F.col("name").alias("term")), "src").join(named.select(F.col("uri").alias("dst"), F.col("name").alias("end")), "dst").select("term", "end")

    def _properties(self, label: str) -> DataFrame:
        c = self.catalog.need()
        return infer.hierarchy(self.graph, label, c.subPropertyOfRel, c.relNamePropName)

    def _start(self, name: str) -> DataFrame:
        return self.spark.createDataFrame([(name,)], "node string")

    def nodes_labelled(self, label: str, **p) -> DataFrame:
        return infer.nodes_labelled(self.graph, label, self._classes(p.get("catLabel"), p.get("subCatRel"), p.get("catNameProp")))

    def nodes_in_category(self, category: str, distinct: bool = True, **p) -> DataFrame:
        c = self.catalog.config
        return infer.nodes_in_category(self.graph, category, p.get("inCatRel") or infer.default_category_rel(c), p.get("subCatRel") or (c or GraphConfig()).subClassOfRel, distinct)

    def get_rels(self, uri: str, rel: str, **p) -> DataFrame:
        c = self.catalog.config or GraphConfig()
        props = infer.hierarchy(self.graph, p.get("relLabel") or c.objectPropertyLabel, p.get("subRelRel") or c.subPropertyOfRel, p.get("relNameProp") or c.relNamePropName)
        return infer.rels(self.graph, uri, rel, props, p.get("relDir", ""))

    def labels(self, **p) -> DataFrame:
        return infer.inferred_labels(self.graph, self._classes(p.get("catLabel"), p.get("subCatRel"), p.get("catNameProp")))

    def class_outgoing_rels(self, name: str, include_all: bool = False) -> DataFrame:
        c = self.catalog.need()
        return infer.class_terms(self._start(name), self._classes(), self._named_links(c.domainRel, c.objectPropertyLabel), self._properties(c.objectPropertyLabel), include_all)

    def class_incoming_rels(self, name: str, include_all: bool = False) -> DataFrame:
        c = self.catalog.need()
        return infer.class_terms(self._start(name), self._classes(), self._named_links(c.rangeRel, c.objectPropertyLabel), self._properties(c.objectPropertyLabel), include_all)

    def class_props(self, name: str, include_all: bool = False) -> DataFrame:
        c = self.catalog.need()
        return infer.class_terms(self._start(name), self._classes(), self._named_links(c.domainRel, c.dataTypePropertyLabel), self._properties(c.dataTypePropertyLabel), include_all)

    def _rel_ends(self, name: str, rel: str, include_all: bool) -> DataFrame:
        c = self.catalog.need()
        links = self._named_links(rel, c.objectPropertyLabel).select(F.col("term").alias("end"), F.col("end").alias("term"))
        return infer.rel_classes(self._start(name), self._properties(c.objectPropertyLabel), links, self._classes(), include_all)

    def rel_target_classes(self, name: str, include_all: bool = False) -> DataFrame:
        return self._rel_ends(name, self.catalog.need().rangeRel, include_all)

    def rel_source_classes(self, name: str, include_all: bool = False) -> DataFrame:
        return self._rel_ends(name, self.catalog.need().domainRel, include_all)

    def has_label(self, uri: str, label: str, **p) -> bool:
        got = infer.has_label(self.graph.nodes.where(F.col("uri") == uri), label, self._classes(p.get("catLabel"), p.get("subCatRel"), p.get("catNameProp")))
        return not got.where("has_label").isEmpty()

    def in_category(self, uri: str, category: str, **p) -> bool:
        """``searchTopDown`` chooses between two ways to one answer and changes nothing here."""
        c = self.catalog.config
        pairs = self.spark.createDataFrame([(uri, category)], "uri string, category string")
        got = infer.in_category(self.graph, pairs, p.get("inCatRel") or infer.default_category_rel(c), p.get("subCatRel") or (c or GraphConfig()).subClassOfRel)
        return got.first().in_category

    def _taxonomy(self, **p) -> DataFrame:
        """Edges between class names; a config overrules the call's names."""
        c = self.catalog.config
        if c is not None:
            return self._classes()
        return self._classes(p.get("classLabel"), p.get("subClassOfRel"))

    def _pair(self, a: str, b: str) -> DataFrame:
        return self.spark.createDataFrame([(a, b)], "a string, b string")

    def pathsim_value(self, a: str, b: str, simulate_root: bool = True, **p) -> float:
        return similarity.path_similarity(self._taxonomy(**p), self._pair(a, b), simulate_root).first().similarity

    def lchsim_value(self, a: str, b: str, simulate_root: bool = True, **p) -> float:
        return similarity.lch_similarity(self._taxonomy(**p), self._pair(a, b), simulate_root).first().similarity

    def wupsim_value(self, a: str, b: str, simulate_root: bool = True, **p) -> float:
        return similarity.wup_similarity(self._taxonomy(**p), self._pair(a, b), simulate_root).first().similarity

    def pathsim_search(self, a: str, least: float, **p) -> DataFrame:
        return similarity.path_search(self._taxonomy(**p), self._start(a), least).select("node", "similarity").orderBy(F.desc("similarity"), "node")

    def lchsim_search(self, a: str, least: float, mode: str = "score", **p) -> DataFrame:
        return similarity.lch_search(self._taxonomy(**p), self._start(a), least, mode).select("node", "similarity").orderBy(F.desc("similarity"), "node")

    def pathsim_path(self, a: str, b: str, simulate_root: bool = True, **p) -> DataFrame:
        return similarity.paths(self._taxonomy(**p), self._pair(a, b), simulate_root=simulate_root)

    def pathsim_explain(self, a: str, b: str, simulate_root: bool = True, **p) -> str | None:
        got = similarity.explained(self._taxonomy(**p), self._pair(a, b), simulate_root=simulate_root).first()
        return got.text if got else None

    # --- validation -------------------------------------------------------------------------------------------

    def _shapes(self, source: str, fmt: str, inline: bool) -> DataFrame:
        rows = self._read(source, fmt, None, inline)[0].collect()  # shapes: a document of rules
        made = shacl.read_shapes(rows)
        for c in made:
            if c.target_query:
                shacl.check_target_query(self.graph, c.target_query)
        self.catalog.shapes = made
        return self.list_shapes()

    def shacl_import_inline(self, text: str, fmt: str = "Turtle") -> DataFrame:
        return self._shapes(text, fmt, True)

    def shacl_import_fetch(self, path: str, fmt: str = "Turtle") -> DataFrame:
        return self._shapes(path, fmt, False)

    def list_shapes(self) -> DataFrame:
        return shacl.list_shapes(self.spark, self.catalog.shapes)

    def drop_shapes(self) -> None:
        self.catalog.shapes = []

    def view_plans(self) -> list[tuple[str, str]]:
        return shacl.plan_texts(self.graph, self.catalog.shapes, self.catalog)

    def validate(self) -> DataFrame:
        return shacl.validate(self.graph, self.catalog.shapes, self.catalog)

    def validate_set(self, nodes: DataFrame) -> DataFrame:
        return shacl.validate(self.graph, self.catalog.shapes, self.catalog, nodes)

    # --- data-importer models ---------------------------------------------------------------------------------

    def dimodel_inline(self, text: str, fmt: str, classes: list[str] | None = None) -> dict:
        return dimodel.build_model(self._read(text, fmt, None, True)[0], classes)

    def dimodel_fetch(self, path: str, fmt: str, classes: list[str] | None = None) -> dict:
        return dimodel.build_model(self._read(path, fmt, None, False)[0], classes)

    def dimodel_export_inline(self, text: str, fmt: str, folder: str, classes: list[str] | None = None) -> str:
        return dimodel.export_model(self._read(text, fmt, None, True)[0], folder, classes)

    def dimodel_export_fetch(self, path: str, fmt: str, folder: str, classes: list[str] | None = None) -> str:
        return dimodel.export_model(self._read(path, fmt, None, False)[0], folder, classes)
