"""Parsers, writers and the mapping of triples to a graph."""

import bz2
import gzip
import io
import tarfile
import zipfile

import pytest
from pyspark.sql import Row

from quadrille.config import GraphConfig, GraphConfigError, Mappings, PrefixError, Prefixes
from quadrille.engine import Engine
from quadrille.model import RDF, XSD, Graph
from quadrille.sources.jsonld import json_tree
from quadrille.sources.readers import parse_text, read, unpacked
from quadrille.sources.terms import ParseError
from quadrille.sources.writers import Document, negotiate

TTL = """@prefix ex: <http://ex.org/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
PREFIX foaf: <http://foaf/>
ex:a a ex:T ; ex:p "x"@en, \"\"\"long "q" text\"\"\", 3, 4.5, 1e6, true, "2020-01-01"^^xsd:date ;
  foaf:knows [ foaf:name 'Bo\\u00e9' ; ] ; ex:l (1 "two" ex:c) .
<< ex:a foaf:knows ex:b >> ex:since 2020 .
[] ex:z ex:a.b . # a comment
"""


def facts(rows):
    """Statements without the names of blank nodes."""
    t = lambda x, lit=False: "_" if not lit and x.startswith("_:") else x
    return sorted((t(s.subject), s.predicate, t(s.object, s.isLiteral), s.isLiteral, str(s.literalType), str(s.literalLang), str(s.subjectSPO), str(s.graph)) for s in rows)


def test_turtle():
    rows = parse_text(TTL, "Turtle-star")
    assert len(rows) == 19 and [r.ord for r in rows] == list(range(19))
    assert {(r.object, r.literalType) for r in rows if r.predicate == "http://ex.org/p"} >= {("3", XSD + "integer"), ("4.5", XSD + "decimal"), ("1e6", XSD + "double"), ("true", XSD + "boolean"), ("x", RDF + "langString")}
    star = next(r for r in rows if r.subjectSPO)
    assert star.subjectSPO == ["http://ex.org/a", "http://foaf/knows", "http://ex.org/b"] and star.object == "2020"
    assert facts(parse_text(Document([r._asdict() for r in rows], {"ex": "http://ex.org/"}).write("Turtle-star"), "Turtle-star")) == facts(rows)


@pytest.mark.parametrize("text", ["ex:a ex:b ex:c .", "<http://a> <http://b> .", "<http://a> <http://b> 'x", '<http://a b> <http://b> "x" .', "<http://a> _:b <http://c> ."])
def test_bad_turtle(text):
    with pytest.raises(ParseError):
        parse_text(text, "Turtle")


def test_relaxed_iris():
    assert parse_text("<http://a/x y> <http://b> 1 .", "Turtle", strict=False)[0].subject == "http://a/x y"


def test_named_graphs():
    rows = parse_text("@prefix : <http://e/> . :g1 { :a :b :c . } :d :e 'f' . GRAPH :g2 { :q :r :s, :t }", "TriG")
    assert [r.graph for r in rows] == ["http://e/g1", None, "http://e/g2", "http://e/g2"]
    again = parse_text('<http://a> <http://b> "c\\n"@en-us <http://g> .\n_:x <http://b> _:y .\n', "N-Quads")
    assert again[0].graph == "http://g" and again[0].object == "c\n" and again[1].graph is None
    for fmt in ("TriG", "N-Quads"):
        assert facts(parse_text(Document([r._asdict() for r in rows]).write(fmt), fmt)) == facts(rows)


XML = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns:e="http://e/"><e:T rdf:about="http://e/a" e:n="v">
<e:p xml:lang="fr">x</e:p><e:q rdf:resource="http://e/b"/><e:r><rdf:Description rdf:about="http://e/c"><e:k rdf:datatype="http://www.w3.org/2001/XMLSchema#int">5</e:k></rdf:Description></e:r>
<e:s rdf:parseType="Collection"><rdf:Description rdf:about="http://e/1"/></e:s><e:u rdf:parseType="Resource"><e:k>1</e:k></e:u></e:T></rdf:RDF>"""


def test_rdfxml_and_writers():
    rows = parse_text(XML, "RDF/XML")
    got = {(r.subject, r.predicate, r.object) for r in rows}
    assert {("http://e/a", RDF + "type", "http://e/T"), ("http://e/a", "http://e/n", "v"), ("http://e/a", "http://e/q", "http://e/b"), ("http://e/c", "http://e/k", "5")} <= got
    for fmt in ("RDF/XML", "JSON-LD", "N-Triples", "Turtle"):
        assert facts(parse_text(Document([r._asdict() for r in rows]).write(fmt), fmt)) == facts(rows), fmt
    with pytest.raises(ParseError):
        parse_text("<rdf:RDF", "RDF/XML")


def test_jsonld():
    rows = parse_text('{"@context":{"@vocab":"http://s/","knows":{"@type":"@id"},"ex":"http://ex/"},"@id":"http://a","@type":"P","name":"N","ex:q":{"@value":"v","@language":"de"},"knows":["http://b",{"name":"C"}],"n":5,"f":1.5,"l":{"@list":[1,2]}}', "JSON-LD")
    got = {(r.predicate, r.object) for r in rows}
    assert {("http://s/name", "N"), ("http://ex/q", "v"), ("http://s/knows", "http://b"), ("http://s/n", "5"), (RDF + "type", "http://s/P")} <= got
    assert json_tree("", "http://x") == [] and json_tree("{}", "http://x") == []
    assert {s.object for s in json_tree('{"a": {"b": [1, 2]}}', "http://x") if s.isLiteral} == {"1", "2"}


def test_negotiation():
    assert negotiate("json") == "JSON-LD" and negotiate(None, "application/n-triples;q=1") == "N-Triples" and negotiate() == "Turtle"


def test_archives():
    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("in/a.ttl", "zip")
    t = io.BytesIO()
    with tarfile.open(fileobj=t, mode="w:gz") as f:
        info = tarfile.TarInfo("b.ttl")
        info.size = 3
        f.addfile(info, io.BytesIO(b"tar"))
    assert unpacked("x.zip", z.getvalue(), "in/a.ttl") == b"zip" and unpacked("x.tgz", t.getvalue(), None) == b"tar"
    assert unpacked("x.ttl.gz", gzip.compress(b"g"), None) == b"g" and unpacked("x.bz2", bz2.compress(b"b"), None) == b"b"
    with pytest.raises(ParseError):
        unpacked("x.zip", z.getvalue(), None)


def test_files(spark, tmp_path):
    nt = '# head\n<http://a> <http://b> "tab\\tq\\"\\u00e9"@en .\n_:x <http://b> "5"^^<http://www.w3.org/2001/XMLSchema#int> .\n\n<http://a> <http://c> <http://d> .\n'
    (tmp_path / "x.nt").write_text(nt)
    (tmp_path / "x.ttl.gz").write_bytes(gzip.compress(TTL.encode()))
    got = read(spark, str(tmp_path / "x.nt"), "N-Triples").orderBy("ord").collect()
    assert [(r.subject, r.object, r.literalLang) for r in got] == [("http://a", 'tab\tq"é', "en"), ("_:x", "5", None), ("http://a", "http://d", None)]
    assert facts(parse_text(nt, "N-Triples")) == facts(got)
    assert facts(read(spark, str(tmp_path / "x.ttl.gz"), "Turtle-star").collect()) == facts(parse_text(TTL, "Turtle-star"))


def test_config():
    assert GraphConfig.of({"classLabelName": "K"}).classLabel == "K" and not GraphConfig.of({"handleVocabUris": "IGNORE"}).is_rdf
    for bad in ({"handleVocabUris": "NO"}, {"nothing": 1}):
        with pytest.raises(GraphConfigError):
            GraphConfig.of(bad)
    assert GraphConfig.of({"keepLangTag": True}).changed({"keepLangTag": False}).keepLangTag is False


def test_prefixes_and_mappings():
    p = Prefixes()
    p.add("ex", "http://ex/")
    p.add("ex", "http://ex/")
    for prefix, ns in (("ex", "http://other/"), ("other", "http://ex/"), ("rdf", "http://x/")):
        with pytest.raises(PrefixError):
            p.add(prefix, ns)
    p.allocate(["http://n/", "http://ex/", "http://m/"])
    assert p.prefix_of("http://n/") == "ns0" and p.prefix_of("http://m/") == "ns1"
    p.add_from_text('@prefix a-b: <http://ab/> .\nxmlns:c="http://c/"')
    assert p.own["a_b"] == "http://ab/" and p.own["c"] == "http://c/"
    m = Mappings()
    m.add("http://ex/T", "Thing", p)
    m.add("http://ex/U", "Thing", p)
    assert m.iri_of == {"Thing": "http://ex/U"} and m.drop_all("http://ex/") == 1
    with pytest.raises(PrefixError):
        m.add("http://unknown/T", "T", p)


MULTI = "@prefix ex: <http://ex.org/> . ex:a a ex:Person, ex:Boss ; ex:name 'A'@en, 'Ah'@fr ; ex:tag 'x', 'y', 5, 'x' ; ex:knows ex:b ."


def engine(spark, **params):
    e = Engine(spark)
    e.graphconfig_init(params)
    return e


def values(e, key):
    from pyspark.sql import functions as F

    return sorted(r.lex for r in e.graph.props.where(F.col("key") == key).collect())


def test_import_modes(spark):
    e = engine(spark, handleVocabUris="IGNORE")
    r = e.rdf_import_inline(MULTI, "Turtle")
    assert (r.terminationStatus, r.triplesLoaded, r.triplesParsed) == ("OK", 9, 9)
    assert values(e, "name") == ["Ah"] and values(e, "tag") == ["x"]
    e = engine(spark, handleVocabUris="IGNORE", handleMultival="ARRAY")
    assert e.rdf_import_inline(MULTI, "Turtle").triplesLoaded == 8
    assert values(e, "tag") == ["x", "y"]
    e = engine(spark, handleVocabUris="KEEP", handleMultival="ARRAY", handleRDFTypes="NODES")
    assert e.rdf_import_inline(MULTI, "Turtle", {"strictDataTypeCheck": False, "languageFilter": "en"}).triplesLoaded == 8
    assert values(e, "http://ex.org/tag") == ["5^^xsd__long", "x", "y"] and values(e, "http://ex.org/name") == ["A"]
    assert e.graph.edges.count() == 3
    bad = e.rdf_import_inline("<a", "Turtle")
    assert bad.terminationStatus == "KO" and bad.extraInfo
    assert Engine(spark).rdf_import_inline(MULTI, "Turtle").terminationStatus == "KO"
    assert "Unrecognized" in e.rdf_import_inline(MULTI, "HTML").extraInfo


def test_round_trip_add_delete(spark):
    e = engine(spark, handleMultival="ARRAY")
    e.rdf_import_inline(MULTI, "Turtle")
    text = e.describe("http://ex.org/a", format_="Turtle")
    rows = parse_text(text, "Turtle")
    assert {(r.predicate, r.object) for r in rows} >= {("http://ex.org/tag", "x"), ("http://ex.org/knows", "http://ex.org/b"), (RDF + "type", "http://ex.org/Boss")}
    got = e.rdf_delete_inline("<http://ex.org/a> <http://ex.org/tag> 'x' ; <http://ex.org/knows> <http://ex.org/b> ; a <http://ex.org/Boss> ; <http://ex.org/no> 1 . _:b <http://ex.org/tag> 'z' .", "Turtle")
    assert got.triplesDeleted == 3 and "1 statements" in got.extraInfo
    assert [r.uri for r in e.graph.nodes.collect()] == ["http://ex.org/a"]
    e.add_node("http://ex.org/c", ["http://ex.org/Person"], [{"key": "http://ex.org/age", "val": 7}])
    e.add_relationship_uris("http://ex.org/c", "http://ex.org/knows", [{"key": "http://ex.org/since", "val": 2021}], "http://ex.org/a")
    assert e.rdf_export_spo("http://ex.org/c").count() == 3
    with pytest.raises(ValueError):
        e.add_relationship_uris("http://ex.org/c", "http://ex.org/knows", None, "http://ex.org/nobody")
    with pytest.raises(GraphConfigError):
        e.graphconfig_init()


def test_quads_and_preview(spark):
    q = "@prefix : <http://e/> . :g { :a :p 1 . } :h { :a :p 2 ; :q :a . }"
    e = engine(spark, handleVocabUris="IGNORE")
    assert e.quadrdf_import_inline(q, "Turtle").terminationStatus == "KO"
    assert e.quadrdf_import_inline(q, "TriG").triplesLoaded == 3
    assert sorted((r.graph, r.lex) for r in e.graph.props.collect()) == [("http://e/g", "1"), ("http://e/h", "2")]
    e.quadrdf_delete_inline("@prefix : <http://e/> . :h { :a :p 2 . }", "TriG")
    assert [r.graph for r in e.graph.props.collect()] == ["http://e/g"]
    p = engine(spark, handleVocabUris="IGNORE").rdf_preview_inline(MULTI, "Turtle", {"limit": 2})
    assert p.nodes.first().labels == ["Boss", "Person", "Resource"] and p.props.isEmpty()


def test_saved_graph(spark, tmp_path):
    from quadrille.model import Graph

    e = engine(spark)
    e.rdf_import_inline(MULTI, "Turtle")
    e.graph.save(str(tmp_path / "g"))
    back = Graph.load(spark, str(tmp_path / "g"))
    assert sorted(map(tuple, back.props.collect())) == sorted(map(tuple, e.graph.props.collect()))


def test_collect(spark):
    from quadrille.operators.collect import collect

    e = engine(spark)
    e.rdf_import_inline(MULTI, "Turtle")
    view = e.rdf_export_spo()
    for fmt, name in (("nt", "N-Triples"), ("ttl", "Turtle"), ("xml", "RDF/XML"), ("json", "JSON-LD"), ("ttlstar", "Turtle-star")):
        got = collect(view, fmt, "subject").first().rdf
        assert facts(parse_text(got, name)) == facts(view.distinct().withColumns({"graph": view.literalLang}).collect())


def test_collect_parts(spark, tmp_path):
    from quadrille.operators.collect import PART_CHARS, collect_parts

    spo = "if(id % 3 = 0, null, array(concat('http://ex.org/s', id), 'http://ex.org/p', concat('_:b', id % 7)))"
    lit = "id % 5 > 0"
    view = spark.range(20_000).selectExpr(
        "id % 2 AS k", f"if({spo} is null, concat('http://ex.org/s', id div 9), concat('<< ', array_join({spo}, ' '), ' >>')) AS subject", "'graph://schema#qty' AS predicate",
        f"if({lit}, concat(id % 4, ' \"x\\n', repeat('y', 200)), 'http://ex.org/o') AS object", f"{lit} AS isLiteral", f"if({lit}, '{XSD}string', null) AS literalType", "cast(null AS string) AS literalLang", f"{spo} AS subjectSPO")
    view = view.unionByName(view.where("k = 1 and subject like '%1 %'")).unionByName(view.limit(1).selectExpr("9L AS k", "'http://ex.org/one' AS subject", "predicate", "object", "isLiteral", "literalType", "literalLang", "cast(null AS array<string>) AS subjectSPO"))
    want = sorted(map(repr, view.distinct().selectExpr("k", "subject", "predicate", "object", "literalType", "subjectSPO").collect()))
    row = lambda k, s: Row(k=k, subject=s.subject, predicate=s.predicate, object=s.object, literalType=s.literalType, subjectSPO=s.subjectSPO)
    texts = collect_parts(view, "ttlstar", "k", prefixes={"b": "graph://schema#"}).collect()
    assert len({r.k for r in texts}) == 3 < len(texts) and max(len(r.rdf) for r in texts) < 1.5 * PART_CHARS
    assert sorted(repr(row(r.k, s)) for r in texts for s in parse_text(r.rdf, "Turtle-star")) == want
    whole = {k: "".join(r.rdf for r in texts if r.k == k) for k in (0, 1, 9)}
    assert sorted(repr(row(k, s)) for k, x in whole.items() for s in parse_text(x, "Turtle-star")) == want
    then = collect_parts(view, "ttlstar", "k", then=lambda key, text: [(*key, len(parse_text(text, "Turtle-star")))] if key[0] < 9 else [], schema="k long, n long")
    assert {r.k: r.n for r in then.groupBy("k").sum("n").toDF("k", "n").collect()} == {k: sum(x.startswith(f"Row(k={k},") for x in want) for k in (0, 1)}


def test_no_task_holds_a_group_of_the_star_round_trip(spark):
    import __spark_entry__ as entry

    plan = entry.queries()["turtle_star_round_trip"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan


def test_parser_forgets_iris_with_their_prefix():
    text = "@prefix a: <http://x/> . a:s a:p a:o . @prefix a: <http://y/> . a:s a:p <r> . @base <http://z/> . a:s a:p <r> ."
    assert [(s.subject, s.object) for s in parse_text(text, "Turtle")] == [("http://x/s", "http://x/o"), ("http://y/s", "http://example.org/base/r"), ("http://y/s", "http://z/r")]


def test_line_strings_that_cannot_be_read_fail(spark):
    from quadrille.config import ParserConfig
    from quadrille.sources.readers import _lines

    read = lambda text: _lines(spark.createDataFrame([(f'<http://a> <http://b> "{text}" .',)], "value string"), ParserConfig()).first().object
    assert read("x \\U0001F600 \\u00E9 y") == "x \U0001f600 é y"
    assert read("\\\\U0001F600") == "\\U0001F600" and read("\\\\\\U0001F600\\t") == "\\\U0001f600\t"
    with pytest.raises(Exception, match="not an N-Triples string"):
        read("\\x")


def test_blank_nodes_of_two_files_stay_apart(spark, tmp_path):
    from quadrille.sources.readers import read

    for k in "ab":
        (tmp_path / f"{k}.nt").write_text("_:x <http://p> _:y .\n_:y <http://p> _:x .\n")
        (tmp_path / f"{k}.ttl").write_text("_:x <http://p> _:y .\n")
    lines, docs = read(spark, f"{tmp_path}/*.nt", "N-Triples").collect(), read(spark, f"{tmp_path}/*.ttl", "Turtle").collect()
    assert len({x for r in lines for x in (r.subject, r.object)}) == 4 == len({x for r in docs for x in (r.subject, r.object)})
    assert len({r.ord for r in docs}) == 2


def test_a_node_is_checked_in_each_graph_by_itself(spark):
    from quadrille.operators.shacl import Constraint, validate

    g = Graph(
        spark.createDataFrame([("n", "g1", ["T"]), ("n", "g2", ["T"]), ("n", None, ["T"])], "uri string, graph string, labels array<string>"),
        Graph.empty(spark).props,
        spark.createDataFrame([("n", "p", "a", "g1"), ("n", "p", "b", "g2"), ("n", "p", "c", None), ("n", "p", "d", None)], "src string, type string, dst string, graph string"),
        Graph.empty(spark).edge_props,
    )
    got = validate(g, [Constraint("count", target="graph://schema#T", path="graph://schema#p", params={"maxCount": 1.0})]).collect()
    assert [r.resultMessage for r in got] == ["cardinality (2) is outside the defined min-max limits"]
