"""Ontologies, inference, similarity, SHACL, importer models and streams on small graphs."""

import math

import pytest

from quadrille.engine import Engine
from quadrille.operators.closure import CyclicHierarchy, ancestors, forest_ancestors, longest_ways, path_counts
from quadrille.operators.shacl import ShapeError
from quadrille.streaming.validation import ValidationFailed, touched_nodes, validate_change, validating_sink

ONTO = """@prefix owl: <http://www.w3.org/2002/07/owl#> . @prefix rdfs: <http://www.w3.org/2000/01/rdf-schema#> . @prefix ex: <http://ex.org/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
ex:A a owl:Class ; rdfs:label "AA" ; rdfs:subClassOf ex:C . ex:B a owl:Class ; rdfs:subClassOf ex:C . ex:C a owl:Class ; rdfs:subClassOf ex:G .
ex:D a owl:Class ; rdfs:subClassOf ex:F . ex:E a owl:Class ; rdfs:subClassOf ex:F . ex:F a owl:Class ; rdfs:subClassOf ex:G . ex:G a owl:Class .
ex:X a owl:Class ; rdfs:subClassOf ex:Y , [ a owl:Restriction ; owl:onProperty ex:p ; owl:someValuesFrom ex:D ] . ex:Y a owl:Class .
ex:p a owl:ObjectProperty, owl:TransitiveProperty ; rdfs:domain ex:C ; rdfs:range ex:F . ex:q a owl:ObjectProperty ; rdfs:subPropertyOf ex:p ; rdfs:domain ex:A ; rdfs:range ex:D .
ex:d a owl:DatatypeProperty ; rdfs:domain ex:G ; rdfs:range xsd:int . ex:nobody rdfs:label "untyped" ."""


@pytest.fixture(scope="module")
def onto(spark):
    e = Engine(spark)
    e.graphconfig_init({"handleVocabUris": "IGNORE"})
    assert e.onto_import_inline(ONTO, "Turtle").terminationStatus == "OK"
    return e


def test_ontology(onto):
    edges = {(r.src[-1], r.type, r.dst[-1]) for r in onto.graph.edges.collect()}
    assert {("A", "SCO", "C"), ("q", "SPO", "p"), ("p", "DOMAIN", "C"), ("q", "RANGE", "D"), ("X", "SCO_RESTRICTION", "D")} <= edges
    about = {r.key: r.lex for r in onto.graph.edge_props.collect()}
    assert about == {"onPropertyURI": "http://ex.org/p", "onPropertyName": "p", "restrictionType": "SOME"}
    assert {r.lex for r in onto.graph.props.where("key = 'label'").collect()} == {"AA"}
    assert {r.lex for r in onto.graph.props.where("key = 'propCharacteristics'").collect()} == {"Transitive"}


def test_similarity(onto):
    assert math.isclose(onto.pathsim_value("A", "B"), 1 / 3) and math.isclose(onto.pathsim_value("A", "D"), 1 / 5)
    assert math.isclose(onto.pathsim_value("A", "X"), 1 / 6) and onto.pathsim_value("A", "X", simulate_root=False) == 0
    assert math.isclose(onto.wupsim_value("A", "B"), 2 * 2 / 6) and onto.lchsim_value("A", "A") == math.inf
    assert math.isclose(onto.lchsim_value("A", "B"), -math.log(2 / 6)) and onto.lchsim_value("A", "X", simulate_root=False) == 0
    assert {r.node for r in onto.pathsim_search("B", 0.3).collect()} == {"A", "C", "G"}
    assert {r.node for r in onto.pathsim_search("C", 0.3).collect()} == {"A", "B", "F", "G"}
    assert onto.pathsim_explain("A", "B") == "A is a type of C\nB is a type of C"
    assert onto.pathsim_path("A", "X").first().path[-1].dst == "ROOT" and onto.pathsim_explain("A", "X", simulate_root=False) is None


def test_inference_on_the_ontology(onto):
    names = lambda df: {r.term for r in df.collect()}
    assert names(onto.class_outgoing_rels("A", True)) == {"p", "q"} and names(onto.class_outgoing_rels("A")) == {"q"}
    assert names(onto.class_incoming_rels("D", True)) == {"p", "q"} and names(onto.class_props("A")) == {"d"}
    assert names(onto.rel_target_classes("q", True)) == {"D", "F"} and names(onto.rel_target_classes("q")) == {"D"}
    assert names(onto.rel_source_classes("q")) == {"A"}


def test_labels(spark):
    e = Engine(spark)
    e.graphconfig_init({"handleVocabUris": "IGNORE"})
    e.onto_import_inline(ONTO, "Turtle")
    e.rdf_import_inline("<http://i/1> a <http://ex.org/A> . <http://i/2> a <http://ex.org/C> . <http://i/3> a <http://ex.org/D> ; <http://ex.org/q> <http://i/1> . <http://i/4> <http://ex.org/type> <http://ex.org/A> .", "Turtle")
    assert {r.uri for r in e.nodes_labelled("C").collect()} == {"http://i/1", "http://i/2"}
    assert {r.uri for r in e.nodes_labelled("Unknown").collect()} == set()
    assert e.has_label("http://i/1", "G") and not e.has_label("http://i/3", "C")
    assert {"A", "C", "G", "D", "F"} <= {r.label for r in e.labels().collect()}
    assert {r.uri for r in e.nodes_in_category("http://ex.org/G").collect()} == {"http://i/4"} and e.in_category("http://i/4", "http://ex.org/C")
    assert {(r.type, r.node) for r in e.get_rels("http://i/3", "p", relDir=">").collect()} == {("q", "http://i/1")}


def test_skos(spark):
    e = Engine(spark)
    e.graphconfig_init({"handleVocabUris": "IGNORE"})
    r = e.skos_import_inline("""@prefix skos: <http://www.w3.org/2004/02/skos/core#> . @prefix xl: <http://www.w3.org/2008/05/skos-xl#> . @prefix : <http://e/> .
    :a a skos:Concept ; skos:prefLabel "A"@en ; skos:broader :b . :b skos:narrower :c ; skos:related :a ; xl:altLabel :l . :l xl:literalForm "Bee" .""", "Turtle")
    assert r.terminationStatus == "OK"
    assert {(x.src[-1], x.type, x.dst[-1]) for x in e.graph.edges.collect()} == {("a", "SCO", "b"), ("c", "SCO", "b"), ("b", "RELATED", "a")}
    assert {(x.uri[-1], x.key, x.lex) for x in e.graph.props.collect()} >= {("a", "prefLabel", "A"), ("b", "altLabel", "Bee")}


def test_cycles(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 5), (None, 1)], "child int, parent int")
    got = {(r.node, r.ancestor): r.depth for r in ancestors(e).collect()}
    assert got[4, 3] == 3 and got[1, 1] == 0 and len(got) == 13
    with pytest.raises(CyclicHierarchy):
        path_counts(e)


SHAPES = """@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix ex: <http://ex.org/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
ex:S a sh:NodeShape ; sh:targetClass ex:P ; sh:property [ sh:path ex:age ; sh:datatype xsd:integer ; sh:minCount 1 ; sh:maxInclusive 5.5 ; sh:severity sh:Warning ; sh:message "too old" ] ;
  sh:property [ sh:path ex:code ; sh:pattern "[A-Z]+" ; sh:minLength 2 ] ; sh:property [ sh:path [ sh:inversePath ex:knows ] ; sh:maxCount 1 ] ;
  sh:property [ sh:path ex:knows ; sh:class ex:P ; sh:nodeKind sh:IRI ] ; sh:property [ sh:path ex:kind ; sh:in ("a" "b") ] .
ex:Closed a sh:NodeShape ; sh:targetClass ex:Q ; sh:closed true ; sh:ignoredProperties ( ex:x ) ; sh:property [ sh:path ex:y ] ; sh:not [ sh:class ex:P ] ."""
DATA = """@prefix ex: <http://ex.org/> . ex:1 a ex:P ; ex:age 3 ; ex:code "AB" ; ex:knows ex:2 ; ex:kind "a" . ex:2 a ex:P ; ex:age 7 ; ex:code "A1" ; ex:kind "c" ; ex:knows ex:3 .
ex:3 a ex:Q, ex:P ; ex:x 1 ; ex:y 2 ; ex:z 3 ; ex:age "old" . ex:4 ex:knows ex:2 ."""


@pytest.mark.parametrize("mode", ["IGNORE", "SHORTEN", "KEEP"])
def test_shacl(spark, mode):
    e = Engine(spark)
    e.graphconfig_init({"handleVocabUris": mode})
    e.rdf_import_inline(DATA, "Turtle")
    assert e.shacl_import_inline(SHAPES).count() > 5
    all_ = e.validate().collect()
    got = {(r.focusNode[-1], r.propertyShape.split("#")[1].removesuffix("ConstraintComponent")) for r in all_}
    assert got == {("2", "MaxInclusive"), ("2", "Pattern"), ("2", "MaxCount"), ("2", "In"), ("3", "Datatype"), ("3", "Closed"), ("3", "Not")} | {("3", "Class")} - {("3", "Class")}
    row = next(r for r in all_ if "MaxInclusive" in r.propertyShape)
    assert row.customMessage == "too old" and row.severity.endswith("Warning") and row.offendingValue == "7"
    closed = {r.resultPath.split("/")[-1] for r in all_ if "Closed" in r.propertyShape}
    assert closed == {"z", "age"}
    some = spark.createDataFrame([("http://ex.org/1",)], "uri string")
    assert e.validate_set(some).count() == 0 and e.validate_set(e.graph.nodes).count() == len(all_) and e.validate_set(some.limit(0)).count() == 0
    assert len(e.view_plans()) > 5
    e.drop_shapes()
    assert e.validate().count() == 0


def test_shape_errors(spark):
    e = Engine(spark)
    e.graphconfig_init()
    e.rdf_import_inline(DATA, "Turtle")
    with pytest.raises(ShapeError):
        e.shacl_import_inline('@prefix sh: <http://www.w3.org/ns/shacl#> . <http://s> a sh:NodeShape ; sh:targetQuery "no such (" ; sh:property [ sh:path <http://p> ; sh:minCount 1 ] .')


def test_change_validation(spark):
    from quadrille.operators.shacl import read_shapes
    from quadrille.sources.readers import inline

    e = Engine(spark)
    e.graphconfig_init({"handleVocabUris": "IGNORE"})
    e.rdf_import_inline(DATA, "Turtle")
    shapes = read_shapes(inline(spark, SHAPES, "Turtle").collect())
    ok = spark.createDataFrame([("http://ex.org/1",)], "uri string")
    bad = spark.createDataFrame([("http://ex.org/1", "http://ex.org/2")], "src string, dst string")
    validate_change(e.graph, shapes, touched_nodes(e.graph, ok), e.catalog)
    with pytest.raises(ValidationFailed):
        validate_change(e.graph, shapes, touched_nodes(e.graph, edges=bad), e.catalog)
    assert {r.uri[-1] for r in touched_nodes(e.graph, deleted=spark.createDataFrame([("http://ex.org/2",)], "uri string")).collect()} == {"1", "3", "4"}
    wrote = []
    validating_sink(lambda b: e.graph, [], lambda b, n: wrote.append(n), e.catalog)(ok, 4)
    assert wrote == [4]
    with pytest.raises(ValidationFailed):
        validating_sink(lambda b: e.graph, shapes, lambda b, n: wrote.append(n), e.catalog)(ok, 5)
    assert wrote == [4]


def test_importer_model(spark, tmp_path):
    import json

    e = Engine(spark)
    got = e.dimodel_inline(ONTO, "Turtle")
    model = json.loads(got["modelFile"])
    assert {n["label"] for n in model["nodes"]} == {"A", "B", "D", "E", "X"}
    assert {r["type"] for r in model["relationships"]} == {"p", "q"} and "mapping_add" in got["mappingsScript"]
    path = e.dimodel_export_inline(ONTO, "Turtle", str(tmp_path))
    assert json.load(open(path)) == model


def test_entry_points():
    import __spark_entry__ as entry

    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 80


@pytest.mark.parametrize("name", ["spo_predicate", "closure_up", "shacl_count", "ingest_array_distinct", "pathsim_pairs", "find_by_prop"])
def test_queries_against_sql(spark, name):
    import duckdb

    import __spark_entry__ as entry

    d, c = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"):
        c.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    df = entry.queries()[name](spark, d)
    cols = sorted(df.columns)
    norm = lambda rows: sorted(repr(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in rows)
    assert norm(tuple(r) for r in df.select(*cols).collect()) == norm(c.sql(entry.oracle_sql()[name]).select(", ".join(cols)).fetchall())


def test_longest_ways_and_cycles(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("c", "a"), ("d", "c"), ("d", "d"), ("x", None)], "child string, parent string")
    assert {r.node: r.longest for r in longest_ways(edges).collect()} == {"a": 0, "b": 1, "c": 2, "d": 3}
    for more in [("p", "q"), ("q", "p")], [("a", "e"), ("e", "d")], [("b", "d")]:
        with pytest.raises(CyclicHierarchy):
            longest_ways(edges.union(spark.createDataFrame(more, "child string, parent string"))).collect()


def test_forest_ancestors_deep_and_many(spark):
    # Beyond the rows and the levels that one recursive query may have.
    wide = spark.range(1, 150_001).selectExpr("id AS child", "(id - 1) div 3 AS parent")
    pairs = forest_ancestors(wide)
    depth_of = [0]
    for i in range(1, 150_001):
        depth_of.append(depth_of[(i - 1) // 3] + 1)
    got = pairs.selectExpr("count(*) AS n", "sum(depth) AS steps", "count_if(ancestor = 0) AS roots").first()
    assert tuple(got) == (sum(depth_of), sum(d * (d + 1) // 2 for d in depth_of), 150_000) and got.n > 1_000_000
    assert {(r.ancestor, r.depth) for r in pairs.where("node = 100").collect()} == {(33, 1), (10, 2), (3, 3), (0, 4)}
    chain = spark.range(1, 1101).selectExpr("id AS child", "id - 1 AS parent")
    got = forest_ancestors(chain).selectExpr("count(*) AS n", "max(depth) AS deepest", "count_if(node - ancestor <> depth) AS wrong").first()
    assert tuple(got) == (1100 * 1101 // 2, 1100, 0)


def test_forest_ancestors_odd(spark):
    edges = spark.createDataFrame([("b", "a"), ("b", "a"), ("c", "b"), ("d", "d"), ("x", None), (None, "a")], "child string, parent string")
    assert sorted(map(tuple, forest_ancestors(edges).collect())) == [("b", "a", 1), ("c", "a", 2), ("c", "b", 1)]
    assert forest_ancestors(edges.limit(0)).count() == 0
    for more in [("p", "q"), ("q", "p")], [("a", "c")]:
        with pytest.raises(CyclicHierarchy):
            forest_ancestors(edges.union(spark.createDataFrame(more, "child string, parent string")))
