"""Test tables -> raw feeds, with defects injected by rule (blank keys, returns, zero quantities...).

The mappings are part of the test set-up, not of the pipelines; see FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POS = """
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS id_transaccion,
       CASE WHEN l_suppkey % 53 = 0 THEN NULL
            ELSE concat('T', cast(l_suppkey % 8 + 1 AS string)) END AS codigo_tienda,
       concat('Tienda ', cast(l_suppkey % 8 + 1 AS string)) AS nombre_tienda,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            WHEN l_partkey % 89 = 0 THEN '   '
            ELSE concat('  sku-', cast(l_partkey % 100 AS string), ' ') END AS codigo_producto,
       CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity END AS qty,
       p_retailprice AS precio,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS total,
       l_shipdate AS fecha_hora_venta,
       o_custkey AS id_cliente
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
"""

ECOMMERCE = """
SELECT cast(event_id AS string) AS order_id,
       concat('sku-', get_json_object(props, '$.k')) AS product_sku,
       1 + event_id % 3 AS quantity,
       cast(round(value * 100) AS bigint) AS unit_price,
       cast(round(value * 100) AS bigint) * (1 + event_id % 3) AS total_amount,
       ts AS created_at,
       concat('user', cast(user_id AS string), '@example.com') AS customer_email
FROM {events} WHERE event_type = 'purchase'
"""

INVENTARIO = """
SELECT concat(cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS inv_id,
       concat('T', cast(l_suppkey % 8 + 1 AS string)) AS store_code,
       concat('Tienda ', cast(l_suppkey % 8 + 1 AS string)) AS store_name,
       concat(' sku-', cast(l_partkey % 100 AS string)) AS product_code,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS qty_on_hand,
       p_size AS qty_reserved,
       l_shipdate AS last_updated
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""

# Nine stores and 101 skus against the ERP's eight and 100, so both sides have unmatched keys.
CONTEOS = """
SELECT concat('c', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS count_id,
       concat('T', cast(l_suppkey % 9 + 1 AS string)) AS store_code,
       concat('sku-', cast(l_partkey % 101 AS string)) AS product_code,
       l_quantity AS counted_qty,
       l_shipdate AS counted_at
FROM {lineitem}
"""


def _tabla(spark: SparkSession, sf_dir: str, nombre: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{nombre}.parquet")


def _feed(spark: SparkSession, sf_dir: str, consulta: str, *tablas: str) -> DataFrame:
    return spark.sql(consulta, **{t: _tabla(spark, sf_dir, t) for t in tablas})


def ventas_tiendas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, POS, "lineitem", "orders", "part")


def ventas_ecommerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, ECOMMERCE, "events")


def ventas_ecommerce_de(eventos: DataFrame, *auxiliares: str) -> DataFrame:
    """The same mapping over any events frame, streaming ones included, keeping some of its columns."""
    extra = "".join(f", {c}" for c in auxiliares)
    return eventos.sparkSession.sql(ECOMMERCE.replace("AS customer_email", f"AS customer_email{extra}"), events=eventos)


def inventario(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, INVENTARIO, "lineitem", "part")


def conteos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, CONTEOS, "lineitem")
