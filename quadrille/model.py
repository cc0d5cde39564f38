"""The shapes of data: triples, and a property graph as four long tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

TRIPLES = "subject string, predicate string, object string, isLiteral boolean, literalType string, literalLang string, subjectSPO array<string>, graph string, ord long"
NODES = "uri string, graph string, labels array<string>"
PROPS = "uri string, graph string, key string, ord long, type string, lex string, lang string, datatype string"
EDGES = "src string, type string, dst string, graph string"
EDGE_PROPS = "src string, type_ string, dst string, graph string, key string, ord long, type string, lex string, lang string, datatype string"
RESULTS = ("focusNode", "nodeType", "shapeId", "propertyShape", "offendingValue", "resultPath", "severity", "resultMessage", "customMessage")

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
SKOSXL = "http://www.w3.org/2008/05/skos-xl#"
SH = "http://www.w3.org/ns/shacl#"
XSD = "http://www.w3.org/2001/XMLSchema#"
SCHEMA = "http://schema.org/"
TYPE = RDF + "type"
#: Namespace of names that have none of their own.
BASE = "graph://schema#"
INDIVIDUALS = "graph://individuals#"
RESOURCE = "Resource"


@dataclass(frozen=True)
class Graph:
    """nodes (uri, graph, labels), props (a row a value), edges and edge_props; all lazy."""

    nodes: DataFrame
    props: DataFrame
    edges: DataFrame
    edge_props: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession) -> Graph:
        return cls(*(spark.createDataFrame([], s) for s in (NODES, PROPS, EDGES, EDGE_PROPS)))

    def with_(self, **frames: DataFrame) -> Graph:
        return replace(self, **frames)

    def is_empty(self) -> bool:
        return self.nodes.isEmpty()

    def save(self, path: str) -> None:
        """As Parquet, property and edge tables partitioned by key and type so that scans prune."""
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        self.props.write.mode("overwrite").partitionBy("key").parquet(f"{path}/props")
        self.edges.write.mode("overwrite").partitionBy("type").parquet(f"{path}/edges")
        self.edge_props.write.mode("overwrite").parquet(f"{path}/edge_props")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Graph:
        read = {n: spark.read.parquet(f"{path}/{n}") for n in ("nodes", "props", "edges", "edge_props")}
        order = {n: [c.split()[0] for c in s.split(", ")] for n, s in zip(read, (NODES, PROPS, EDGES, EDGE_PROPS), strict=True)}
        return cls(*(read[n].select(*order[n]) for n in read))
