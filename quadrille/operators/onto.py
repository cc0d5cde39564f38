"""Ontologies (RDFS, OWL) and SKOS as graphs of classes and properties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Catalog, ParserConfig
from ..functions import iri
from ..functions.iri import _prefix_map
from ..model import OWL, RDF, RDFS, RESOURCE, SKOS, SKOSXL, TYPE, Graph
from .closure import settled
from .ingest import ImportResult, _bnode, mapped, settle_values

#: Predicates stored as texts of a term, and kinds of property that are noted (fixed values).
ANNOTATIONS = (RDFS + "label", RDFS + "comment", SKOS + "prefLabel", SKOS + "altLabel", SKOS + "definition")
CHARACTERISTICS = ("TransitiveProperty", "InverseFunctionalProperty", "SymmetricProperty", "FunctionalProperty")
CARDINALITIES = ("cardinality", "minCardinality", "maxCardinality", "qualifiedCardinality", "minQualifiedCardinality", "maxQualifiedCardinality")
NULL = "cast(null as string)"


def _own(catalog: Catalog, name: str) -> str:
    """A name of the base vocabulary as the graph stores it."""
    c = catalog.need()
    mode = c.handleVocabUris
    return f"{c.baseSchemaPrefix}__{name}" if mode.startswith("SHORTEN") else c.baseSchemaNamespace + name if mode == "KEEP" else name


def _props(frame: DataFrame, key, lex, lang=None) -> DataFrame:
    k = F.lit(key) if isinstance(key, str) else key
    return frame.select("uri", F.expr(NULL).alias("graph"), k.alias("key"), "ord", F.lit("string").alias("type"), lex.alias("lex"), (F.expr(NULL) if lang is None else lang).alias("lang"), F.expr(NULL).alias("datatype"))


def _prepare(triples: DataFrame, catalog: Catalog, parser: ParserConfig) -> DataFrame:
    c = catalog.need()
    if c.handleVocabUris.startswith("SHORTEN") and catalog.prefixes.prefix_of(c.baseSchemaNamespace) is None:
        catalog.prefixes.add(c.baseSchemaPrefix, c.baseSchemaNamespace)
    t = triples.withColumns({"subject": _bnode(F.col("subject")), "object": F.when(F.col("isLiteral"), F.col("object")).otherwise(_bnode(F.col("object")))})
    if parser.languageFilter is not None:
        t = t.where(F.col("literalLang").isNull() | (F.col("literalLang") == parser.languageFilter))
    if parser.predicateExclusionList:
        t = t.where(~F.col("predicate").isin(list(parser.predicateExclusionList)))
    return settled(t)


def load_ontology(triples: DataFrame, catalog: Catalog, parser: ParserConfig | None = None) -> ImportResult:
    """Classes, object and datatype properties with hierarchy, domains, ranges, restrictions, labels and characteristics."""
    parser = parser or ParserConfig()
    t, c = _prepare(triples, catalog, parser), catalog.need()
    iri_object = ~F.col("isLiteral") & ~F.col("object").startswith("bnode://")
    named = ~F.col("subject").startswith("bnode://")
    kinds = {OWL + "Class": c.classLabel, RDFS + "Class": c.classLabel, OWL + "ObjectProperty": c.objectPropertyLabel, RDF + "Property": c.objectPropertyLabel, OWL + "DatatypeProperty": c.dataTypePropertyLabel}
    typed = t.where((F.col("predicate") == TYPE) & F.col("object").isin(list(kinds)) & named)
    typed = typed.select(F.col("subject").alias("uri"), F.try_element_at(_prefix_map({k: _own(catalog, v) for k, v in kinds.items()}), F.col("object")).alias("label"), "ord")
    links = {RDFS + "subClassOf": c.subClassOfRel, RDFS + "subPropertyOf": c.subPropertyOfRel, RDFS + "domain": c.domainRel, RDFS + "range": c.rangeRel, OWL + "equivalentClass": "EQC"}
    rels = t.where(F.col("predicate").isin(list(links)) & named & iri_object)
    rels = rels.select(F.col("subject").alias("src"), F.try_element_at(_prefix_map({k: _own(catalog, v) for k, v in links.items()}), F.col("predicate")).alias("type"), F.col("object").alias("dst"), F.expr(NULL).alias("graph"))
    # Ends of links are nodes of the kind that the link joins.
    ends = {c.subClassOfRel: (c.classLabel, c.classLabel), c.subPropertyOfRel: (c.objectPropertyLabel, c.objectPropertyLabel), c.domainRel: (None, c.classLabel), c.rangeRel: (None, c.classLabel), "EQC": (c.classLabel, c.classLabel)}
    implied = None
    for kind, (a, b) in ends.items():
        e = rels.where(F.col("type") == _own(catalog, kind))
        for col_, label in (("src", a), ("dst", b)):
            x = e.select(F.col(col_).alias("uri"), F.lit(_own(catalog, label) if label else RESOURCE).alias("label"), F.lit(0).cast("long").alias("ord"))
            implied = x if implied is None else implied.unionByName(x)
    every = typed.unionByName(implied)
    nodes = every.select("uri", "label").unionByName(every.select("uri", F.lit(RESOURCE).alias("label"))).groupBy("uri").agg(F.array_sort(F.collect_set("label")).alias("labels")).select("uri", F.expr(NULL).alias("graph"), "labels")
    names = every.groupBy("uri").agg(F.min("ord").alias("ord"))
    name_key = _own(catalog, c.classNamePropName)
    notes = t.where(F.col("predicate").isin(list(ANNOTATIONS)) & F.col("isLiteral")).withColumnRenamed("subject", "uri")
    noted = _props(notes, F.concat(F.lit(_own(catalog, "")), iri.local_name("predicate")), F.col("object"), F.when(F.lit(c.keepLangTag), F.col("literalLang"))).withColumn("predicate", F.col("key"))
    subjects = typed.select("uri").distinct()
    orphan_notes = noted.join(subjects, "uri", "left_anti").count()
    noted = settle_values(noted.join(subjects, "uri", "left_semi"), ["uri", "graph", "key"], c, parser.strictDataTypeCheck)
    traits = t.where((F.col("predicate") == TYPE) & F.col("object").isin([OWL + x for x in CHARACTERISTICS]) & named).select(F.col("subject").alias("uri"), "ord", F.regexp_extract(iri.local_name("object"), "^(.*)Property$", 1).alias("lex"))
    props = _props(names, name_key, iri.local_name("uri")).unionByName(noted.select("uri", "graph", "key", "ord", "type", "lex", "lang", "datatype")).unionByName(_props(traits, _own(catalog, "propCharacteristics"), F.col("lex")).distinct())
    restricted, about, counted = _restrictions(t, catalog)
    edges = rels.unionByName(restricted).distinct()
    loaded = typed.count() + rels.count() + 2 * counted + traits.count() + notes.count() - orphan_notes
    return ImportResult("OK", loaded, triples.count(), catalog.prefixes.all() if c.handleVocabUris.startswith("SHORTEN") else {}, "", {}, Graph(nodes, props, edges, about))


def _restrictions(t: DataFrame, catalog: Catalog) -> tuple[DataFrame, DataFrame, int]:
    """(edges, their properties, how many): OWL restrictions behind blank superclasses and equivalents; incomplete ones go."""
    targets = [OWL + x for x in ("someValuesFrom", "allValuesFrom", "onClass")]
    counts = [OWL + x for x in CARDINALITIES]
    b = t.where(F.col("subject").startswith("bnode://"))
    kind = F.max(F.when(F.col("predicate") == OWL + "someValuesFrom", "SOME").when(F.col("predicate") == OWL + "allValuesFrom", "ALL").when(F.col("predicate").isin(counts), F.upper(iri.local_name("predicate"))))
    parts = b.groupBy(F.col("subject").alias("node")).agg(
        F.max(F.when(F.col("predicate") == OWL + "onProperty", F.col("object"))).alias("prop"), F.max(F.when(F.col("predicate").isin(targets) & ~F.col("isLiteral"), F.col("object"))).alias("dst"),
        kind.alias("kind"), F.max(F.when(F.col("predicate").isin(counts), F.col("object"))).alias("n"))
    parts = parts.where("prop is not null and dst is not null and kind is not null and not startswith(dst, 'bnode://')")
    links = t.where(F.col("predicate").isin(RDFS + "subClassOf", OWL + "equivalentClass") & F.col("object").startswith("bnode://") & ~F.col("subject").startswith("bnode://"))
    rel = F.when(F.col("predicate") == RDFS + "subClassOf", _own(catalog, "SCO_RESTRICTION")).otherwise(_own(catalog, "EQC_RESTRICTION"))
    r = settled(links.select(F.col("subject").alias("src"), rel.alias("type_"), F.col("object").alias("node"), "ord").join(parts, "node"))
    edges = r.select("src", F.col("type_").alias("type"), "dst", F.expr(NULL).alias("graph"))
    pairs = F.array(*[F.struct(F.lit(_own(catalog, k)).alias("key"), v.alias("lex")) for k, v in (("onPropertyURI", F.col("prop")), ("onPropertyName", iri.local_name("prop")), ("restrictionType", F.col("kind")), ("cardinalityVal", F.col("n")))])
    about = r.select("src", "type_", "dst", F.expr(NULL).alias("graph"), F.explode(pairs).alias("p"), "ord").where("p.lex is not null")
    about = about.select("src", "type_", "dst", "graph", "p.key", "ord", F.lit("string").alias("type"), "p.lex", F.expr(NULL).alias("lang"), F.expr(NULL).alias("datatype"))
    return edges, about, links.count()


def load_skos(triples: DataFrame, catalog: Catalog, parser: ParserConfig | None = None) -> ImportResult:
    """Concepts as classes; broader and narrower as one hierarchy; labels, direct or by SKOS-XL, as properties."""
    parser = parser or ParserConfig()
    t, c = _prepare(triples, catalog, parser), catalog.need()
    sco, related, label = _own(catalog, c.subClassOfRel), _own(catalog, "RELATED"), _own(catalog, c.classLabel)
    p, s, o = F.col("predicate"), F.col("subject"), F.col("object")
    links = t.where(p.isin(SKOS + "broader", SKOS + "narrower", SKOS + "related") & ~F.col("isLiteral"))
    down = p == SKOS + "narrower"
    edges = links.select(F.when(down, o).otherwise(s).alias("src"), F.when(p == SKOS + "related", related).otherwise(sco).alias("type"), F.when(down, s).otherwise(o).alias("dst"), F.expr(NULL).alias("graph")).distinct()
    concepts = t.where((p == TYPE) & (o == SKOS + "Concept")).select(s.alias("uri"), "ord")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("uri")).withColumn("ord", F.lit(0).cast("long"))
    every = concepts.unionByName(ends).groupBy("uri").agg(F.min("ord").alias("ord"))
    nodes = every.select("uri", F.expr(NULL).alias("graph"), F.array(F.lit(label), F.lit(RESOURCE)).alias("labels"))
    kinds = ("prefLabel", "altLabel", "hiddenLabel")
    direct = t.where(p.isin([SKOS + k for k in kinds]) & F.col("isLiteral")).select(s.alias("uri"), p, o, "literalLang", "ord")
    via = t.where(p.isin([SKOSXL + k for k in kinds]) & ~F.col("isLiteral")).select(s.alias("uri"), F.concat(F.lit(SKOS), iri.local_name("predicate")).alias("predicate"), o.alias("node"), "ord")
    forms = t.where((p == SKOSXL + "literalForm") & F.col("isLiteral")).select(s.alias("node"), o, "literalLang")
    texts = direct.unionByName(via.join(forms, "node").select("uri", "predicate", "object", "literalLang", "ord"))
    made = _props(texts, F.concat(F.lit(_own(catalog, "")), iri.local_name("predicate")), o, F.when(F.lit(c.keepLangTag), F.col("literalLang"))).withColumn("predicate", F.col("key"))
    values = settle_values(made, ["uri", "graph", "key"], c, parser.strictDataTypeCheck).select("uri", "graph", "key", "ord", "type", "lex", "lang", "datatype")
    props = _props(every, _own(catalog, c.classNamePropName), iri.local_name("uri")).unionByName(values)
    loaded = concepts.count() + links.count() + texts.count()
    empty = Graph.empty(triples.sparkSession)
    return ImportResult("OK", loaded, triples.count(), catalog.prefixes.all() if c.handleVocabUris.startswith("SHORTEN") else {}, "", {}, Graph(nodes, props, edges, empty.edge_props))


__all__ = ["load_ontology", "load_skos", "mapped"]
