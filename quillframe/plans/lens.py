"""The catalogue's tables as plain SQL views of the given star-schema tables.

The views' text is shared by Spark and by the queries' SQL (``{name}`` stands for a table), so
operators meet blank, malformed and repeated values on both sides alike. Operators themselves know
nothing of these views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillframe.operators.classify import classify, operations
from quillframe.sources.shared import stored

_ORG = "CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 47 = 0 THEN '' ELSE n_name END"
_KEY = "CASE WHEN l_orderkey % 211 = 0 THEN '' ELSE 'ds' || CAST(l_orderkey AS STRING) END"
_SUPP = "CAST(l_suppkey AS STRING)"

SPECS = f"""
SELECT 'ds' || CAST(o_orderkey AS STRING) AS id, 'Orders of ' || c_name AS title, 'portal' AS provider, {_ORG} AS organization,
  o_orderpriority AS source_category,
  CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS updated_at,
  CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE 'https://portal.example/data/' || CAST(o_orderkey AS STRING) END AS url
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey
WHERE o_orderkey % 29 <> 0"""

RAW_DEPENDENCIES = f"""
SELECT {_KEY} AS dataset_id, {_ORG} AS organization, o_orderpriority AS source_category,
  'op' || CAST(l_linenumber AS STRING) AS operation, 'portal' AS provider,
  CASE WHEN l_quantity < 2 THEN NULL WHEN l_quantity < 3 THEN ' ' WHEN l_quantity < 4 THEN 'see the guide'
    WHEN l_linenumber = 7 THEN 'http://soap' || {_SUPP} || '.example/service?wsdl'
    WHEN l_linenumber = 6 THEN 'http://map' || {_SUPP} || '.example/wms?service=WMS'
    WHEN l_quantity > 48 THEN 'http://api' || {_SUPP} || '.example:81/'
    WHEN l_returnflag = 'N' THEN 'https://apis.gateway.example/1/op' || CAST(l_partkey AS STRING)
    ELSE 'http://api' || {_SUPP} || '.example:81/v1/get' END AS endpoint,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE 'portal' || CAST(l_suppkey % 7 AS STRING) || '.example' END AS source_host,
  CASE WHEN l_tax > 0.05 THEN 'manual' ELSE 'auto' END AS dev_approval,
  CASE WHEN l_discount > 0.07 THEN 'manual' WHEN l_discount < 0.02 THEN NULL ELSE 'auto' END AS prod_approval,
  CASE WHEN l_suppkey % 6 = 0 THEN 'https://guide' || CAST(l_suppkey % 9 AS STRING) || '.example/how' WHEN l_suppkey % 6 = 1 THEN 'ask the office'
    WHEN l_suppkey % 6 = 2 THEN 'https://apis.gateway.example/guide' END AS guide_url,
  CASE WHEN l_linenumber = 7 THEN 'SOAP' ELSE 'REST' END AS api_type, CASE l_partkey % 3 WHEN 0 THEN 'XML' WHEN 1 THEN 'JSON' ELSE '' END AS data_format,
  l_linenumber % 4 AS request_params_count, l_partkey % 5 AS response_params_count,
  l_returnflag AS flag, l_shipdate AS seen_at, l_partkey AS part_key, l_suppkey AS supp_key, l_extendedprice AS price
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey
  JOIN {{nation}} ON c_nationkey = n_nationkey"""

FLAT_ADAPTERS = """
SELECT 'adapter' || CAST(s_suppkey AS STRING) AS name, 'api' || CAST(s_suppkey AS STRING) || '.example:81' AS host,
  CASE WHEN s_suppkey % 10 = 3 THEN 'api' || CAST(s_suppkey + 1 AS STRING) || '.example:81' END AS second_host,
  CAST(-s_suppkey AS INT) AS ordinal, s_suppkey % 3 <> 0 AS can_call
FROM {supplier} WHERE s_acctbal > 0"""

#: Evidence of every operation; of two in three the operation's name is missing, so that it belongs to none.
EVIDENCE = """
SELECT dataset_id, CASE WHEN part_key % 3 = 0 THEN operation END AS operation, provider, endpoint_host, dependency_class,
  CASE WHEN flag = 'A' THEN 'verified' WHEN flag = 'R' THEN 'failed' WHEN part_key % 7 = 0 THEN 'odd' WHEN part_key % 11 = 0 THEN NULL ELSE 'skipped' END AS status,
  CASE WHEN flag = 'A' THEN NULL WHEN flag = 'R' AND part_key % 2 = 0 THEN 'probe_timeout' WHEN flag = 'R' THEN 'http_error'
    WHEN part_key % 4 = 0 THEN 'missing_required_params' ELSE 'missing_auth' END AS reason,
  CASE WHEN flag = 'A' THEN 200 WHEN flag = 'R' AND part_key % 2 = 0 THEN NULL WHEN flag = 'R' AND part_key % 5 = 0 THEN 404
    WHEN flag = 'R' THEN 503 END AS http_status,
  seen_at AS verified_at, part_key, supp_key, price
FROM {deps}"""
#: A total order of the evidence of one key.
ORDER = ["verified_at", "part_key", "supp_key", "price"]

#: What ``classify`` computes, for the queries' SQL.
_AUTHORITY = r"nullif(regexp_extract(trim(endpoint), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1), '')"
CLASSIFIED_SQL = rf"""
SELECT *, CASE WHEN dependency_class = 'gateway' THEN 'builtin'
    WHEN dependency_class IN ('external_endpoint', 'service_root') THEN CASE WHEN adapter IS NOT NULL THEN 'adapter' ELSE 'missing' END
    ELSE 'not_applicable' END AS adapter_status,
  coalesce(dev_approval = 'manual', false) OR coalesce(prod_approval = 'manual', false) AS approval_required,
  dependency_class NOT IN ('no_endpoint', 'service_root') AS callable
FROM (SELECT c.*, a.name AS adapter FROM (
    SELECT *, coalesce(nullif(endpoint_host, ''), nullif(source_host, '')) AS route_host,
      nullif(regexp_extract(guide_url, '^https://([^/]*)', 1), '') AS guide_host, request_params_count = 1 AS lacks_params FROM (
      SELECT *, CASE WHEN dependency_class <> 'service_root' THEN {_AUTHORITY} END AS endpoint_host FROM (
        SELECT *, CASE WHEN coalesce(trim(endpoint), '') = '' THEN 'no_endpoint' WHEN {_AUTHORITY} IS NULL THEN 'malformed_endpoint'
          WHEN regexp_matches(lower(trim(endpoint)), '[?&]wsdl|\.asmx([?#]|$)') THEN 'soap'
          WHEN regexp_matches(lower(trim(endpoint)), '[?&]service=wms|/wms([?#]|$)') THEN 'wms'
          WHEN regexp_matches(trim(endpoint), '^[A-Za-z]+://[^/?#]*/?$') THEN 'service_root'
          WHEN {_AUTHORITY} = 'apis.gateway.example' THEN 'gateway' ELSE 'external_endpoint' END AS dependency_class
        FROM raw_deps))) c LEFT JOIN by_host a ON c.route_host = a.host)"""

_TABLES = ("orders", "customer", "nation", "lineitem", "supplier")
_NAMES = {t: t for t in _TABLES} | {"deps": "deps"}
LATEST_SQL = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(dataset_id, ''), coalesce(operation, ''), coalesce(endpoint_host, ''),
  coalesce(dependency_class, '') ORDER BY verified_at DESC, part_key DESC, supp_key DESC, price DESC) AS rn FROM evidence) WHERE rn = 1"""
SAME_KEY_SQL = " AND ".join(f"coalesce(d.{c}, '') = coalesce(e.{c}, '')" for c in ("dataset_id", "operation", "endpoint_host", "dependency_class"))


def with_views(query: str) -> str:
    """``query`` with the views as common table expressions, for DuckDB."""
    views = {
        "specs": SPECS.format(**_NAMES),
        "raw_deps": RAW_DEPENDENCIES.format(**_NAMES),
        "adapters": FLAT_ADAPTERS.format(**_NAMES),
        "adapter_hosts": "SELECT name, host, ordinal FROM adapters UNION ALL SELECT name, second_host, ordinal FROM adapters WHERE second_host IS NOT NULL",
        "by_host": "SELECT host, arg_max(name, ordinal) AS name FROM adapter_hosts GROUP BY host",
        "deps": CLASSIFIED_SQL,
        "evidence": EVIDENCE.format(**_NAMES),
        "latest": LATEST_SQL,
        "attached": f"SELECT d.*, e.status, e.reason, e.http_status, e.dataset_id IS NOT NULL AS has_evidence FROM deps d LEFT JOIN latest e ON {SAME_KEY_SQL}",
    }
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in views.items()) + "\n" + query


#: Bytes a core below which a table counts as small.
SMALL = 4 << 20


class Lens:
    """The views over the tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._kept: DataFrame | None = None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    def spread(self, name: str, key: str = "l_orderkey") -> DataFrame:
        """A table; a small one is dealt to all cores, for its file is one row group and so one task.
        Large tables have many and are read as they are."""
        df = self.table(name)
        cores = self.spark.sparkContext.defaultParallelism
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        return df.repartition(cores, key) if size < SMALL * cores else df

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """``text`` with ``{name}`` for a given frame or a table."""
        used = {t: self.spread(t) if t == "lineitem" else self.table(t) for t in _TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used, **frames)

    def specs(self) -> DataFrame:
        return self.sql(SPECS)

    def adapters(self) -> DataFrame:
        flat = self.sql(FLAT_ADAPTERS)
        caps = F.when(F.col("can_call"), F.array(F.lit("call"), F.lit("verification"))).otherwise(F.array(F.lit("verification")))
        hosts = F.array_compact(F.array("host", "second_host"))
        return flat.select("name", F.lit("registered").alias("status"), hosts.alias("hosts"), caps.alias("capabilities"), "ordinal")

    def deps(self) -> DataFrame:
        """Classified operations."""
        names = F.when(F.col("request_params_count") == 1, F.array(F.lit("q1"))).otherwise(F.array().cast("array<string>"))
        return classify(self.sql(RAW_DEPENDENCIES), self.adapters()).withColumn("missing_params", names)

    def kept(self) -> DataFrame:
        """``deps`` written once a job, for reports that read them several times."""
        if self._kept is None:
            self._kept = stored(self.deps())
        return self._kept

    def evidence(self, deps: DataFrame | None = None) -> DataFrame:
        return self.sql(EVIDENCE, deps=self.deps() if deps is None else deps)

    def nested_specs(self) -> DataFrame:
        """Specs with their operations and parameters as nested arrays, in a fixed order."""
        raw = self.sql(RAW_DEPENDENCIES).where("dataset_id <> ''")

        def fields(prefix: str, n):
            numbers = F.when(n > 0, F.sequence(F.lit(1), n.cast("int"))).otherwise(F.array().cast("array<int>"))
            return F.transform(numbers, lambda k: F.struct(F.concat(F.lit(prefix), k.cast("string")).alias("name"), F.lit("a label").alias("label")))

        def nested_op(x):  # made of the sorted rows, so that these alone are shuffled
            code = F.element_at(F.array(*map(F.lit, ("resultCode", "resultMsg", "returnAuthMsg", "errMsg", "total"))), (x["part_key"] % 5 + 1).cast("int"))
            region = F.when(x["part_key"] % 2 == 0, "").otherwise("x")
            defaults = F.create_map(F.lit("pageNo"), F.lit("1"), F.lit("region"), region)
            response = F.array(F.struct(code.alias("name"), F.lit("a label").alias("label")))
            return F.struct(x["operation"].alias("name"), x["endpoint"].alias("endpoint"), defaults.alias("default_params"), fields("q", x["request_params_count"]).alias("request_params"), response.alias("response_params"))

        # The operations of one spec: an order has a few lines.
        op = F.struct("part_key", "supp_key", "price", "operation", "endpoint", "request_params_count")
        nested = raw.repartition("dataset_id").groupBy("dataset_id").agg(F.transform(F.array_sort(F.collect_list(op)), nested_op).alias("operations"))
        specs = self.specs()
        return specs.join(nested, specs["id"] == nested["dataset_id"], "left").drop("dataset_id")

    def operations(self) -> DataFrame:
        return operations(self.nested_specs())
