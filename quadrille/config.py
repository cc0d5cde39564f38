"""Settings of a graph, prefixes and vocabulary mappings. All of it is small and lives on the driver."""

from __future__ import annotations

import dataclasses
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .model import BASE, OWL, RDF, RDFS, SCHEMA, SH, SKOS, SKOSXL, XSD


class GraphConfigError(ValueError):
    """A setting is wrong, missing or can't be changed now."""


class PrefixError(ValueError):
    """A prefix is undefined, taken or in use."""


#: Reserved prefixes (fixed values).
STANDARD = {"sch": SCHEMA, "skos": SKOS, "skosxl": SKOSXL, "rdfs": RDFS, "owl": OWL, "rdf": RDF, "sh": SH, "xsd": XSD}
VOCAB = ("SHORTEN", "SHORTEN_STRICT", "IGNORE", "MAP", "KEEP")
MULTIVAL = ("OVERWRITE", "ARRAY")
TYPES = ("LABELS", "NODES", "LABELS_AND_NODES")
#: Names of settings in older manuals.
ALIASES = {"classLabelName": "classLabel", "subClassOfRelName": "subClassOfRel", "dataTypePropertyLabelName": "dataTypePropertyLabel", "objectPropertyLabelName": "objectPropertyLabel", "subPropertyOfRelName": "subPropertyOfRel", "domainRelName": "domainRel", "rangeRelName": "rangeRel", "applyNaming": "applyNaming"}


@dataclass(frozen=True)
class GraphConfig:
    handleVocabUris: str = "SHORTEN"
    handleMultival: str = "OVERWRITE"
    handleRDFTypes: str = "LABELS"
    keepLangTag: bool = False
    applyNaming: bool = False
    keepCustomDataTypes: bool = False
    multivalPropList: tuple[str, ...] | None = None
    customDataTypePropList: tuple[str, ...] | None = None
    baseSchemaNamespace: str = BASE
    baseSchemaPrefix: str = "gsch"
    classLabel: str = "Class"
    subClassOfRel: str = "SCO"
    dataTypePropertyLabel: str = "Property"
    objectPropertyLabel: str = "Relationship"
    subPropertyOfRel: str = "SPO"
    domainRel: str = "DOMAIN"
    rangeRel: str = "RANGE"
    classNamePropName: str = "name"
    relNamePropName: str = "name"

    def __post_init__(self):
        for name, allowed in (("handleVocabUris", VOCAB), ("handleMultival", MULTIVAL), ("handleRDFTypes", TYPES)):
            if getattr(self, name) not in allowed:
                raise GraphConfigError(f"{getattr(self, name)} is not a valid option for param '{name}'")
        for name in ("multivalPropList", "customDataTypePropList"):
            if (v := getattr(self, name)) is not None:
                object.__setattr__(self, name, tuple(v))

    @classmethod
    def of(cls, params: dict | None = None) -> GraphConfig:
        return cls().changed(params or {})

    def changed(self, params: dict) -> GraphConfig:
        params = {ALIASES.get(k, k): v for k, v in params.items()}
        known = {f.name for f in dataclasses.fields(self)}
        if unknown := set(params) - known:
            raise GraphConfigError(f"Unknown settings: {', '.join(sorted(unknown))}")
        return dataclasses.replace(self, **params)

    @property
    def is_rdf(self) -> bool:
        """Whether names are kept so that IRIs can be restored."""
        return self.handleVocabUris in ("SHORTEN", "SHORTEN_STRICT", "KEEP")

    def show(self, spark: SparkSession) -> DataFrame:
        rows = [(k, ",".join(v) if isinstance(v, tuple) else str(v).lower() if isinstance(v, bool) else v) for k, v in dataclasses.asdict(self).items() if v is not None]
        return spark.createDataFrame(rows, "param string, value string")


@dataclass(frozen=True)
class ParserConfig:
    """Settings of a call. commitSize, nodeCacheSize and singleTx are accepted and change nothing: a load is one write."""

    predicateExclusionList: tuple[str, ...] = ()
    languageFilter: str | None = None
    verifyUriSyntax: bool = True
    limit: int = 1000
    abortOnError: bool = True
    strictDataTypeCheck: bool = True
    commitSize: int = 25000
    nodeCacheSize: int = 10000
    singleTx: bool = False
    headerParams: dict | None = None
    payload: str | None = None

    @classmethod
    def of(cls, params: dict | None = None) -> ParserConfig:
        params = dict(params or {})
        if "predicateExclusionList" in params:
            params["predicateExclusionList"] = tuple(params["predicateExclusionList"])
        return cls(**params)


class Prefixes:
    """A one-to-one map of prefixes and namespaces; the standard ones are reserved."""

    def __init__(self, own: dict[str, str] | None = None):
        self.own: dict[str, str] = dict(own or {})

    def all(self) -> dict[str, str]:
        return STANDARD | self.own

    def prefix_of(self, ns: str) -> str | None:
        return next((p for p, n in self.all().items() if n == ns), None)

    def add(self, prefix: str, ns: str) -> None:
        have = self.all()
        if have.get(prefix) == ns:
            return
        if prefix in have:
            raise PrefixError(f"prefix {prefix} is in use for namespace <{have[prefix]}>")
        if (other := self.prefix_of(ns)) is not None:
            raise PrefixError(f"namespace <{ns}> has the prefix {other}")
        self.own[prefix] = ns

    def remove(self, prefix: str, mapped: set[str] = frozenset()) -> None:
        if prefix in STANDARD or prefix not in self.own:
            raise PrefixError(f"prefix {prefix} can't be removed: it is {'reserved' if prefix in STANDARD else 'not defined'}")
        if self.own[prefix] in mapped:
            raise PrefixError(f"prefix {prefix} has vocabulary mappings")
        del self.own[prefix]

    def allocate(self, namespaces: list[str]) -> None:
        """A prefix ``ns<k>`` for each namespace without one, in the order given; k counts prefixes that begin with ns."""
        for ns in namespaces:
            if self.prefix_of(ns) is None:
                k = sum(p.startswith("ns") for p in self.all())
                while f"ns{k}" in self.all():
                    k += 1
                self.own[f"ns{k}"] = ns

    #: How Turtle, SPARQL and RDF/XML declare prefixes.
    _DECLARED = (re.compile(r"(?i)@?prefix\s+([\w.-]+)\s*:\s*<([^>]*)>"), re.compile(r"xmlns:([\w.-]+)\s*=\s*[\"']([^\"']*)[\"']"))

    def add_from_text(self, text: str) -> None:
        for pattern in self._DECLARED:
            for prefix, ns in pattern.findall(text):
                if self.prefix_of(ns) is None:
                    self.add(prefix.replace("-", "_").replace(".", "_"), ns)

    def list(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(sorted(self.all().items()), "prefix string, namespace string")


@dataclass
class Mappings:
    """Graph names for vocabulary terms: one name a term, one term a name."""

    iri_of: dict[str, str] = field(default_factory=dict)

    def add(self, iri: str, name: str, prefixes: Prefixes) -> None:
        ns, _ = split_iri(iri)
        if prefixes.prefix_of(ns) is None:
            raise PrefixError(f"no prefix is defined for namespace <{ns}>")
        self.iri_of = {k: v for k, v in self.iri_of.items() if k != name and v != iri} | {name: iri}

    def drop(self, name: str) -> bool:
        return self.iri_of.pop(name, None) is not None

    def drop_all(self, ns: str) -> int:
        gone = [k for k, v in self.iri_of.items() if split_iri(v)[0] == ns]
        for k in gone:
            del self.iri_of[k]
        return len(gone)

    def name_of(self) -> dict[str, str]:
        return {v: k for k, v in self.iri_of.items()}

    def list(self, spark: SparkSession, prefixes: Prefixes, text: str = "") -> DataFrame:
        rows = []
        for name, iri in sorted(self.iri_of.items()):
            ns, local = split_iri(iri)
            if text.lower() in name.lower() or text.lower() in local.lower():
                rows.append((ns, prefixes.prefix_of(ns), local, name))
        return spark.createDataFrame(rows, "schemaNs string, schemaPrefix string, schemaElement string, elemName string")


def split_iri(iri: str) -> tuple[str, str]:
    """(namespace, local name), as ``functions.iri`` has them."""
    for mark in "#/:":
        if mark in iri:
            at = iri.rindex(mark) + 1
            return iri[:at], iri[at:]
    return "", iri


@dataclass
class Catalog:
    """What is known of a graph besides its data."""

    config: GraphConfig | None = None
    prefixes: Prefixes = field(default_factory=Prefixes)
    mappings: Mappings = field(default_factory=Mappings)
    shapes: list = field(default_factory=list)
    shape_triples: list = field(default_factory=list)

    def need(self) -> GraphConfig:
        if self.config is None:
            raise GraphConfigError("A graph config is needed: call graphconfig_init() first")
        return self.config
