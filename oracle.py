"""DuckDB SQL for the registered queries, written independently of the Spark code.

Shared pieces are common table expressions; `sql(name)` puts the needed ones in front.
"""

from __future__ import annotations

import re

TS = "TIMESTAMP '2025-04-13 10:00:00'"

CTE = {
    # --- raw feeds (FIXTURES.md) ---
    "pos": """
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS id_transaccion,
       CASE WHEN l_suppkey % 53 = 0 THEN NULL
            ELSE concat('T', CAST(l_suppkey % 8 + 1 AS VARCHAR)) END AS codigo_tienda,
       concat('Tienda ', CAST(l_suppkey % 8 + 1 AS VARCHAR)) AS nombre_tienda,
       CASE WHEN l_partkey % 97 = 0 THEN NULL
            WHEN l_partkey % 89 = 0 THEN '   '
            ELSE concat('  sku-', CAST(l_partkey % 100 AS VARCHAR), ' ') END AS codigo_producto,
       CASE WHEN l_linenumber = 7 THEN 0 ELSE l_quantity END AS qty,
       p_retailprice AS precio,
       CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS total,
       l_shipdate AS fecha_hora_venta,
       o_custkey AS id_cliente
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "ecom": """
SELECT CAST(event_id AS VARCHAR) AS order_id,
       concat('sku-', json_extract_string(props, '$.k')) AS product_sku,
       1 + event_id % 3 AS quantity,
       CAST(round(value * 100) AS BIGINT) AS unit_price,
       CAST(round(value * 100) AS BIGINT) * (1 + event_id % 3) AS total_amount,
       ts AS created_at,
       concat('user', CAST(user_id AS VARCHAR), '@example.com') AS customer_email
FROM events WHERE event_type = 'purchase'""",
    "inv": """
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS inv_id,
       concat('T', CAST(l_suppkey % 8 + 1 AS VARCHAR)) AS store_code,
       concat('Tienda ', CAST(l_suppkey % 8 + 1 AS VARCHAR)) AS store_name,
       concat(' sku-', CAST(l_partkey % 100 AS VARCHAR)) AS product_code,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END AS qty_on_hand,
       p_size AS qty_reserved, l_shipdate AS last_updated
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "cnt": """
SELECT concat('c', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS count_id,
       concat('T', CAST(l_suppkey % 9 + 1 AS VARCHAR)) AS store_code,
       concat('sku-', CAST(l_partkey % 101 AS VARCHAR)) AS product_code,
       l_quantity AS counted_qty, l_shipdate AS counted_at
FROM lineitem""",
    # --- typed feeds ---
    "pos_t": f"""
SELECT id_transaccion AS venta_id, 'tienda_fisica' AS canal, codigo_tienda AS tienda_id,
       nombre_tienda AS tienda_nombre, upper(trim(codigo_producto)) AS sku,
       CAST(trunc(qty) AS INTEGER) AS cantidad,
       CAST(precio AS DECIMAL(10,2)) AS precio_unitario, CAST(total AS DECIMAL(12,2)) AS monto_total,
       'MXN' AS moneda,
       (fecha_hora_venta AT TIME ZONE 'America/Mexico_City') AT TIME ZONE 'UTC' AS vendido_en,
       sha256(CAST(id_cliente AS VARCHAR)) AS cliente_id,
       'bronze/ventas_tiendas' AS _fuente, {TS} AS _procesado_en,
       (codigo_producto IS NULL OR trim(codigo_producto) = '') AS sin_sku,
       (codigo_tienda IS NULL OR trim(codigo_tienda) = '') AS sin_tienda
FROM pos""",
    "ecom_t": f"""
SELECT order_id AS venta_id, 'ecommerce' AS canal, CAST(NULL AS VARCHAR) AS tienda_id,
       CAST(NULL AS VARCHAR) AS tienda_nombre, upper(trim(product_sku)) AS sku,
       CAST(quantity AS INTEGER) AS cantidad,
       CAST(CAST(unit_price AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS precio_unitario,
       CAST(CAST(total_amount AS DECIMAL(18,2)) / 100 AS DECIMAL(12,2)) AS monto_total,
       'MXN' AS moneda, created_at AS vendido_en, sha256(customer_email) AS cliente_id,
       'bronze/ventas_ecommerce' AS _fuente, {TS} AS _procesado_en,
       (product_sku IS NULL OR trim(product_sku) = '') AS sin_sku, false AS sin_tienda
FROM ecom""",
    "todas": """
SELECT *, CASE WHEN sin_sku OR sin_tienda THEN 'rechazo' WHEN monto_total < 0 THEN 'devolucion'
               WHEN monto_total > 0 AND cantidad > 0 THEN 'valida' ELSE 'rechazo' END AS clase
FROM (SELECT * FROM pos_t UNION ALL BY NAME SELECT * FROM ecom_t)""",
    "inv_t": f"""
SELECT inv_id AS inventario_id, store_code AS tienda_id, store_name AS tienda_nombre,
       upper(trim(product_code)) AS sku,
       CAST(CASE WHEN qty_on_hand - qty_reserved > 0 THEN trunc(qty_on_hand - qty_reserved) ELSE 0 END AS INTEGER)
         AS stock_disponible,
       CAST(qty_reserved AS INTEGER) AS stock_reservado,
       (last_updated AT TIME ZONE 'America/Mexico_City') AT TIME ZONE 'UTC' AS ultima_actualizacion,
       'bronze/inventario' AS _fuente, {TS} AS _procesado_en
FROM inv""",
    "cnt_t": f"""
SELECT count_id AS conteo_id, store_code AS tienda_id, upper(trim(product_code)) AS sku,
       CAST(trunc(counted_qty) AS INTEGER) AS contado,
       (counted_at AT TIME ZONE 'America/Mexico_City') AT TIME ZONE 'UTC' AS contado_en,
       'bronze/conteos_fisicos' AS _fuente, {TS} AS _procesado_en
FROM cnt""",
    # --- Silver ---
    "ventas": """
SELECT venta_id, canal, tienda_id, tienda_nombre, sku, cantidad, precio_unitario, monto_total, moneda,
       vendido_en, cliente_id, _fuente, _procesado_en
FROM (SELECT *, row_number() OVER (PARTITION BY canal, venta_id
        ORDER BY vendido_en DESC NULLS LAST, sku DESC NULLS LAST, monto_total DESC NULLS LAST,
                 tienda_id DESC NULLS LAST, precio_unitario DESC NULLS LAST, cantidad DESC NULLS LAST) AS rn
      FROM todas WHERE clase = 'valida') WHERE rn = 1""",
    "vueltas": """
SELECT * EXCLUDE rn
FROM (SELECT *, row_number() OVER (PARTITION BY canal, venta_id
        ORDER BY vendido_en DESC NULLS LAST, sku DESC NULLS LAST, monto_total DESC NULLS LAST,
                 tienda_id DESC NULLS LAST, precio_unitario DESC NULLS LAST, cantidad DESC NULLS LAST) AS rn
      FROM todas WHERE clase = 'devolucion') WHERE rn = 1""",
    "inventario": """
SELECT * EXCLUDE rn
FROM (SELECT *, row_number() OVER (PARTITION BY tienda_id, sku
        ORDER BY ultima_actualizacion DESC NULLS LAST, inventario_id DESC, stock_disponible DESC,
                 stock_reservado DESC) AS rn FROM inv_t) WHERE rn = 1""",
    "conteos": """
SELECT * EXCLUDE rn
FROM (SELECT *, row_number() OVER (PARTITION BY tienda_id, sku
        ORDER BY contado_en DESC NULLS LAST, conteo_id DESC, contado DESC) AS rn FROM cnt_t) WHERE rn = 1""",
    "con_fecha": "SELECT *, CAST(vendido_en AS DATE) AS fecha FROM ventas",
    "inv_ok": "SELECT * FROM inv_t WHERE stock_reservado IS NOT NULL",
    "tiendas_h": """
SELECT tienda_id, tienda_nombre, dia AS desde, lead(dia) OVER (PARTITION BY tienda_id ORDER BY dia) AS hasta
FROM (SELECT *, lag(tienda_nombre) OVER (PARTITION BY tienda_id ORDER BY dia) AS anterior
      FROM (SELECT tienda_id, CAST(ultima_actualizacion AS DATE) AS dia,
                   max(tienda_nombre || CASE WHEN tienda_id = 'T3' AND CAST(ultima_actualizacion AS DATE) >= DATE '1995-06-16'
                                             THEN ' Norte' ELSE '' END) AS tienda_nombre
            FROM inv_ok GROUP BY 1, 2))
WHERE anterior IS NULL OR anterior <> tienda_nombre""",
    "stock_h": """
SELECT CASE WHEN tercio THEN 'T1' ELSE tienda_id END AS tienda_id, CASE WHEN tercio THEN 'SKU-0' ELSE sku END AS sku,
       inventario_id, stock_disponible, stock_reservado, ultima_actualizacion
FROM (SELECT *, CAST(substr(sku, 5) AS INTEGER) % 3 = 0 AS tercio FROM inv_ok)""",
    "ventas_h": """
SELECT venta_id, CASE WHEN tercio THEN 'T1' ELSE tienda_id END AS tienda_id,
       CASE WHEN tercio THEN 'SKU-0' ELSE sku END AS sku, vendido_en, cantidad
FROM (SELECT *, CAST(substr(sku, 5) AS INTEGER) % 3 = 0 AS tercio FROM ventas WHERE canal = 'tienda_fisica')""",
}

SUMA = "CAST(sum(monto_total) AS DECIMAL(18,2)) AS ventas_totales"
TOTALES = f"{SUMA}, CAST(sum(cantidad) AS BIGINT) AS unidades, count(*) AS n_ventas"
CANONICAS = (
    "venta_id, canal, tienda_id, tienda_nombre, sku, cantidad, precio_unitario, monto_total, moneda, "
    "vendido_en, cliente_id, _fuente, _procesado_en"
)
CLAVES_POS = {
    "codigo_producto": "codigo_producto IS NULL OR trim(codigo_producto) = ''",
    "codigo_tienda": "codigo_tienda IS NULL OR trim(codigo_tienda) = ''",
}


def _metrica(tabla: str, etapa: str, **valores: str) -> str:
    nombres = ["total", "nulos_sku", "nulos_monto", "rechazadas", "devoluciones", "duplicadas"]
    nombres += ["stock_desconocido", "stock_negativo"]
    columnas = ", ".join(f"CAST({valores.get(n, '0')} AS BIGINT) AS {n}" for n in nombres)
    return f"SELECT '{tabla}' AS tabla, '{etapa}' AS etapa, {columnas}"


def _calidad() -> str:
    partes = []
    for tabla, canal in (("ventas_tiendas", "tienda_fisica"), ("ventas_ecommerce", "ecommerce")):
        llaves = f"(SELECT count(*) FROM ventas WHERE canal = '{canal}')"
        vueltas = f"(SELECT count(*) FROM vueltas WHERE canal = '{canal}')"
        partes.append(
            _metrica(
                tabla,
                "bronze_raw",
                total="count(*)",
                nulos_sku="count(*) FILTER (sku IS NULL)",
                nulos_monto="count(*) FILTER (monto_total IS NULL)",
                rechazadas="count(*) FILTER (clase = 'rechazo')",
                devoluciones=vueltas,
                duplicadas=f"count(*) FILTER (clase <> 'rechazo') - {llaves} - {vueltas}",
            )
            + f" FROM todas WHERE canal = '{canal}'"
        )
        partes.append(_metrica(tabla, "silver_clean", total="count(*)") + f" FROM ventas WHERE canal = '{canal}'")
    partes.append(
        _metrica(
            "inventario",
            "bronze_raw",
            total="count(*)",
            nulos_sku="count(*) FILTER (product_code IS NULL)",
            duplicadas="count(*) - (SELECT count(*) FROM inventario)",
            stock_desconocido="count(*) FILTER (qty_on_hand IS NULL OR qty_reserved IS NULL)",
            stock_negativo="count(*) FILTER (qty_on_hand < qty_reserved)",
        )
        + " FROM inv"
    )
    partes.append(_metrica("inventario", "silver_clean", total="count(*)") + " FROM inventario")
    return " UNION ALL ".join(partes)


def _frecuencias() -> str:
    condiciones = {
        "registro_corrupto": "false",
        "vacio:venta_id": "venta_id IS NULL OR trim(venta_id) = ''",
        "vacio:sku": "sin_sku",
        "vacio:tienda_id": "sin_tienda",
        "monto_no_positivo": "monto_total <= 0",
        "cantidad_no_positiva": "cantidad <= 0",
    }
    for c in ("cantidad", "precio_unitario", "monto_total", "vendido_en"):
        condiciones[f"tipo:{c}"] = "false"  # every value of the mapped feed is readable
        condiciones[f"nulo:{c}"] = f"{c} IS NULL"
    return " UNION ALL ".join(
        f"SELECT '{m}' AS motivo, count(*) FILTER ({c}) AS filas, "
        f"count(*) FILTER ({c}) / CAST(count(*) AS DOUBLE) AS proporcion FROM pos_t"
        for m, c in condiciones.items()
    )


CONSOLIDADAS = f"SELECT canal, fecha, {SUMA} FROM con_fecha GROUP BY canal, fecha"
ECOMMERCE = f"SELECT {CANONICAS} FROM ventas WHERE canal = 'ecommerce'"

CUERPOS = {
    "silver_ventas_tiendas": f"SELECT {CANONICAS} FROM ventas WHERE canal = 'tienda_fisica'",
    "silver_ventas_ecommerce": ECOMMERCE,
    "silver_ventas": f"SELECT {CANONICAS} FROM ventas",
    "silver_inventario": "SELECT * FROM inventario",
    "silver_inventario_por_sku": """
SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY sku
  ORDER BY ultima_actualizacion DESC, inventario_id DESC, stock_disponible DESC, stock_reservado DESC,
           tienda_id DESC) AS rn FROM inv_t) WHERE rn = 1""",
    "silver_conteos": "SELECT * FROM conteos",
    "rechazos_ventas": f"""
SELECT {CANONICAS}, concat_ws(',',
    CASE WHEN cantidad <= 0 THEN 'cantidad_no_positiva' END,
    CASE WHEN monto_total <= 0 THEN 'monto_no_positivo' END,
    CASE WHEN sin_sku THEN 'vacio:sku' END,
    CASE WHEN sin_tienda THEN 'vacio:tienda_id' END) AS motivos
FROM todas WHERE clase = 'rechazo'""",
    "rechazos_inventario": f"""
SELECT id_transaccion AS inventario_id, codigo_tienda AS tienda_id, nombre_tienda AS tienda_nombre,
       upper(trim(codigo_producto)) AS sku, CAST(trunc(qty) AS INTEGER) AS stock_disponible, 0 AS stock_reservado,
       (fecha_hora_venta AT TIME ZONE 'America/Mexico_City') AT TIME ZONE 'UTC' AS ultima_actualizacion,
       'bronze/inventario' AS _fuente, {TS} AS _procesado_en,
       concat_ws(',', CASE WHEN {CLAVES_POS['codigo_producto']} THEN 'vacio:sku' END,
         CASE WHEN {CLAVES_POS['codigo_tienda']} THEN 'vacio:tienda_id' END) AS motivos
FROM pos WHERE {CLAVES_POS['codigo_producto']} OR {CLAVES_POS['codigo_tienda']}""",
    "devoluciones": f"SELECT {CANONICAS} FROM vueltas",
    "devoluciones_repetidas": """
SELECT (SELECT count(*) FROM vueltas WHERE canal = 'tienda_fisica') AS devueltas,
       (SELECT count(DISTINCT venta_id) FROM todas WHERE clase = 'devolucion' AND canal = 'tienda_fisica') AS llaves,
       (SELECT count(*) FROM ventas WHERE canal = 'tienda_fisica') AS limpias""",
    "gold_entregas_repetidas": f"""
SELECT canal, CAST(vendido_en AS DATE) AS fecha, {SUMA}
FROM (SELECT canal,
             CASE WHEN CAST(venta_id AS BIGINT) % 6 = 0 THEN vendido_en + INTERVAL 1 DAY ELSE vendido_en END AS vendido_en,
             CASE WHEN CAST(venta_id AS BIGINT) % 6 = 0 THEN monto_total * 2 ELSE monto_total END AS monto_total
      FROM ventas WHERE canal = 'ecommerce') GROUP BY 1, 2""",
    "gold_refresco_tardio": f"""
SELECT canal, CAST(vendido_en + dias * INTERVAL 1 DAY AS DATE) AS fecha,
       CAST(sum(monto_total * veces) AS DECIMAL(18,2)) AS ventas_totales
FROM (SELECT *, CASE WHEN n % 3 = 0 THEN 1 WHEN n % 7 <> 0 THEN 0 ELSE -1 END AS dias,
             CASE WHEN n % 3 = 0 THEN 2 WHEN n % 7 <> 0 THEN 1 ELSE 5 END AS veces
      FROM (SELECT *, CAST(venta_id AS BIGINT) AS n FROM ventas WHERE canal = 'ecommerce'))
WHERE n % 3 = 0 OR n % 7 <> 0 OR n % 4 = 0 GROUP BY 1, 2""",
    "gold_tras_un_corte": f"""
SELECT canal, CAST(vendido_en + dias * INTERVAL 1 DAY AS DATE) AS fecha,
       CAST(sum(monto_total * veces) AS DECIMAL(18,2)) AS ventas_totales
FROM (SELECT *, CASE WHEN n % 5 = 0 THEN 40 WHEN n % 3 = 0 THEN 1 ELSE 0 END AS dias,
             CASE WHEN n % 5 = 0 THEN 3 WHEN n % 3 = 0 THEN 2 ELSE 1 END AS veces
      FROM (SELECT *, CAST(venta_id AS BIGINT) AS n FROM ventas WHERE canal = 'ecommerce')) GROUP BY 1, 2""",
    "bronze_origenes": ECOMMERCE,
    "extraccion_con_solape": ECOMMERCE,
    "silver_parcial": """
SELECT _fuente AS parte, count(*) AS filas FROM ventas GROUP BY _fuente
UNION ALL SELECT unnest(['calidad/ventas_tiendas', 'calidad/ventas_ecommerce', 'calidad/inventario']), 2""",
    "silver_por_hora": f"""
SELECT CAST(10 + CAST(venta_id AS BIGINT) % 2 AS INTEGER) AS hour, count(*) AS n_ventas, {SUMA}
FROM ventas WHERE canal = 'ecommerce' GROUP BY 1""",
    "reproceso_de_fechas": f"""
SELECT CAST(13 - d AS INTEGER) AS day, count(*) AS n_ventas, {SUMA}, count(*) AS medidas
FROM ventas CROSS JOIN range(3) AS r(d)
WHERE canal = 'ecommerce' AND CAST(venta_id AS BIGINT) % 3 IN (d, (d + 1) % 3) GROUP BY d""",
    "stream_sin_perdidas": """
SELECT venta_id, vendido_en,
       CASE WHEN day(vendido_en) < 24 AND vendido_en < (SELECT max(vendido_en) FROM ventas WHERE canal = 'ecommerce')
                 - INTERVAL 10 DAY THEN 'tardias' ELSE 'a_tiempo' END AS parte
FROM ventas WHERE canal = 'ecommerce'""",
    "stream_entregas_repetidas": """
SELECT parte, count(*) AS filas, count(DISTINCT venta_id) AS ventas, CAST(sum(monto_total) AS DECIMAL(18,2)) AS monto
FROM (SELECT venta_id, monto_total, 'a_tiempo' AS parte FROM v
      UNION ALL
      SELECT venta_id, monto_total, CASE WHEN vendido_en < media - INTERVAL 5 DAY THEN 'tardias' ELSE 'repetidas' END
      FROM v WHERE day(vendido_en) <= 15
      UNION ALL
      SELECT venta_id, monto_total, CASE WHEN vendido_en < fin - INTERVAL 5 DAY THEN 'tardias' ELSE 'repetidas' END
      FROM v WHERE day(vendido_en) <= 15)
GROUP BY parte""".replace("FROM v", """FROM (
        SELECT *, max(vendido_en) FILTER (WHERE day(vendido_en) <= 15) OVER () AS media, max(vendido_en) OVER () AS fin
        FROM ventas WHERE canal = 'ecommerce')"""),
    "stream_totales_corregidos": """
SELECT canal, CAST(vendido_en AS DATE) AS fecha, CAST(sum(monto_total * veces) AS DECIMAL(18,2)) AS ventas_totales
FROM (SELECT *, 1 + CASE WHEN n % 3 = 0 THEN -1 ELSE 0 END + CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END AS veces
      FROM (SELECT *, CAST(venta_id AS BIGINT) AS n FROM ventas WHERE canal = 'ecommerce'))
GROUP BY 1, 2""",
    "gold_catalogo_del_dia": f"{CONSOLIDADAS} HAVING fecha = DATE '2024-01-15'",
    "gold_ventas_de_hoy": f"SELECT canal, {SUMA} FROM con_fecha WHERE fecha = DATE '2024-01-15' GROUP BY canal",
    "personas_enmascaradas": """
SELECT c_custkey, sha256(c_name) AS nombre, sha256(' Calle ' || CAST(c_nationkey AS VARCHAR) || ' No. 5 ') AS direccion,
       sha256('4000 0000 0000 ' || substr(lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(4, length(CAST(c_custkey AS VARCHAR))) AS INTEGER), '0'), 1, 4)) AS tarjeta
FROM customer""",
    "rechazos_inventario_erp": """
SELECT motivos, count(*) AS count FROM (
  SELECT concat_ws(',', CASE WHEN n % 17 = 0 THEN 'nulo:ultima_actualizacion' END,
                        CASE WHEN falta THEN 'nulo:stock_reservado' END,
                        CASE WHEN n % 19 = 0 THEN 'vacio:inventario_id' END,
                        CASE WHEN n % 13 = 0 THEN 'vacio:sku' END,
                        CASE WHEN n % 11 = 0 THEN 'vacio:tienda_id' END) AS motivos
  FROM (SELECT CAST(split_part(inv_id, '-', 1) AS BIGINT) AS n, qty_reserved IS NULL AS falta FROM inv))
WHERE motivos <> '' GROUP BY motivos""",
    "registros_validos": "SELECT * FROM pos WHERE NOT ({}) AND NOT ({})".format(*CLAVES_POS.values()),
    "registros_vacios": """
SELECT *, concat_ws(',', CASE WHEN {0} THEN 'vacio:codigo_producto' END,
                         CASE WHEN {1} THEN 'vacio:codigo_tienda' END) AS motivos
FROM pos WHERE ({0}) OR ({1})""".format(*CLAVES_POS.values()),
    "clientes_enmascarados": "SELECT * REPLACE (sha256(customer_email) AS customer_email) FROM ecom",
    "calidad": _calidad(),
    "trabajo_silver_calidad": _calidad(),
    "calidad_cruda": """
SELECT 'ventas_tiendas' AS tabla, 'bronze_raw' AS etapa, count(*) AS total,
       count(*) FILTER (codigo_producto IS NULL) AS nulos_sku, count(*) FILTER (total IS NULL) AS nulos_monto FROM pos
UNION ALL
SELECT 'ventas_ecommerce', 'bronze_raw', count(*), count(*) FILTER (product_sku IS NULL),
       count(*) FILTER (total_amount IS NULL) FROM ecom
UNION ALL
SELECT 'inventario', 'bronze_raw', count(*), count(*) FILTER (product_code IS NULL), 0 FROM inv""",
    "calidad_ventas_unificadas": """
SELECT 'ventas' AS tabla, 'silver_clean' AS etapa, count(*) AS total,
       count(*) FILTER (sku IS NULL) AS nulos_sku, count(*) FILTER (monto_total IS NULL) AS nulos_monto FROM ventas""",
    "duplicados_fuente": """
SELECT copias, count(*) AS llaves, CAST(sum(copias) AS BIGINT) AS filas
FROM (SELECT count(*) AS copias FROM pos GROUP BY id_transaccion) GROUP BY copias""",
    "frecuencia_motivos": _frecuencias(),
    "bronze_por_fecha": """
SELECT CAST(date_trunc('year', fecha_hora_venta) AS DATE) AS fecha, count(*) AS filas,
       CAST(sum(CAST(total AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total FROM pos GROUP BY 1""",
    "bronze_json_ventas": ECOMMERCE,
    "bronze_json_rechazos": "SELECT true AS corrupto, count(*) AS filas FROM events WHERE event_type = 'error'",
    "bronze_csv_ventas": f"SELECT {CANONICAS} FROM ventas WHERE canal = 'tienda_fisica'",
    "ventas_por_dia_podadas": f"""
SELECT 2025 AS year, 4 AS month, CASE WHEN canal = 'ecommerce' THEN 14 ELSE 13 END AS day, canal,
       count(*) AS n_ventas, {SUMA} FROM ventas GROUP BY canal""",
    "silver_por_fecha_de_venta": f"""
SELECT {CANONICAS}, 2024 AS year, 1 AS month, 15 AS day FROM con_fecha
WHERE canal = 'ecommerce' AND fecha = DATE '2024-01-15'""",
    "trabajo_silver": """
SELECT 'ventas' AS tabla, _fuente, 'valida' AS clase, count(*) AS filas FROM ventas GROUP BY _fuente
UNION ALL SELECT 'inventario', _fuente, 'valida', count(*) FROM inventario GROUP BY _fuente
UNION ALL SELECT 'ventas_apartadas', _fuente, clase, count(*) FROM todas WHERE clase = 'rechazo' GROUP BY _fuente, clase
UNION ALL SELECT 'ventas_apartadas', _fuente, clase, count(*) FROM vueltas GROUP BY _fuente, clase""",
    "trabajo_gold": CONSOLIDADAS,
    "extraccion_incremental": "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01 00:00:00'",
    "marca_siguiente": "SELECT greatest(max(o_orderdate), TIMESTAMP '1998-01-01 00:00:00') AS marca FROM orders",
    "stream_ventas_ecommerce": ECOMMERCE,
    "stream_primera_entrega": ECOMMERCE,
    "stream_ventas_totales": f"SELECT canal, fecha, {SUMA} FROM con_fecha WHERE canal = 'ecommerce' GROUP BY canal, fecha",
    "stream_ventas_tardias": f"""
SELECT {CANONICAS} FROM ventas
WHERE canal = 'ecommerce' AND vendido_en < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 15 DAY""",
    "gold_ventas_consolidadas": CONSOLIDADAS,
    "gold_ventas_consolidadas_mexico": f"""
SELECT canal, CAST((vendido_en AT TIME ZONE 'UTC') AT TIME ZONE 'America/Mexico_City' AS DATE) AS fecha, {SUMA}
FROM ventas GROUP BY 1, 2""",
    "gold_ventas_del_dia": f"{CONSOLIDADAS} HAVING fecha = DATE '2024-01-15'",
    "gold_sql_ventas_del_dia": f"{CONSOLIDADAS} HAVING fecha = DATE '2024-01-15'",
    "gold_ventas_por_tienda": f"SELECT tienda_id, {TOTALES} FROM ventas WHERE tienda_id IS NOT NULL GROUP BY tienda_id",
    "gold_ventas_por_sku": f"SELECT sku, {TOTALES} FROM ventas GROUP BY sku",
    "gold_ventas_por_tienda_sku_dia": f"""
SELECT canal, tienda_id, sku, fecha, {TOTALES} FROM con_fecha GROUP BY canal, tienda_id, sku, fecha""",
    "gold_dim_tienda": """
SELECT tienda_id, max(tienda_nombre) AS tienda_nombre
FROM (SELECT tienda_id, tienda_nombre FROM ventas UNION SELECT tienda_id, tienda_nombre FROM inventario)
WHERE tienda_id IS NOT NULL GROUP BY tienda_id""",
    "gold_dim_producto": """
SELECT sku, min(fecha) AS primera_venta, max(fecha) AS ultima_venta FROM con_fecha GROUP BY sku""",
    "gold_dim_fecha": """
SELECT DISTINCT fecha, CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes,
       CAST(quarter(fecha) AS INTEGER) AS trimestre, CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana FROM con_fecha""",
    "gold_estrella_ventas": f"""
SELECT v.canal, coalesce(t.tienda_nombre, 'desconocido') AS tienda_nombre,
       coalesce(p.tiendas_con_stock, 0) AS tiendas_con_stock,
       CAST(year(v.fecha) AS INTEGER) AS anio, CAST(month(v.fecha) AS INTEGER) AS mes,
       {SUMA}, CAST(sum(cantidad) AS BIGINT) AS unidades
FROM con_fecha v
LEFT JOIN (SELECT tienda_id, max(tienda_nombre) AS tienda_nombre FROM inventario
           GROUP BY tienda_id) t ON v.tienda_id = t.tienda_id
LEFT JOIN (SELECT sku, count(DISTINCT tienda_id) AS tiendas_con_stock FROM inventario
           GROUP BY sku) p ON v.sku = p.sku
GROUP BY 1, 2, 3, 4, 5""",
    "gold_tiendas_con_historia": "SELECT * FROM tiendas_h",
    "gold_estrella_con_historia": f"""
SELECT v.canal, coalesce(t.tienda_nombre, 'desconocido') AS tienda_nombre, CAST(year(v.fecha) AS INTEGER) AS anio,
       CAST(month(v.fecha) AS INTEGER) AS mes, {SUMA}, CAST(sum(cantidad) AS BIGINT) AS unidades
FROM con_fecha v LEFT JOIN tiendas_h t
  ON v.tienda_id = t.tienda_id AND v.fecha >= t.desde AND (t.hasta IS NULL OR v.fecha < t.hasta)
GROUP BY 1, 2, 3, 4""",
    "ventas_con_existencias": """
SELECT v.venta_id, v.tienda_id, v.sku, v.vendido_en, v.cantidad, s.stock_disponible, s.stock_reservado, s.ultima_actualizacion
FROM ventas_h v ASOF LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tienda_id, sku, ultima_actualizacion
      ORDER BY inventario_id DESC, stock_disponible DESC, stock_reservado DESC) AS rn FROM stock_h) WHERE rn = 1) s
  ON v.tienda_id = s.tienda_id AND v.sku = s.sku AND v.vendido_en >= s.ultima_actualizacion""",
    "conteos_contra_existencias": """
SELECT c.conteo_id, c.tienda_id, c.sku, c.contado, c.contado_en, stock_disponible + stock_reservado AS en_sistema,
       c.contado - (stock_disponible + stock_reservado) AS diferencia
FROM cnt_t c ASOF LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tienda_id, sku, ultima_actualizacion
      ORDER BY inventario_id DESC, stock_disponible DESC, stock_reservado DESC) AS rn FROM inv_ok) WHERE rn = 1) s
  ON c.tienda_id = s.tienda_id AND c.sku = s.sku AND c.contado_en >= s.ultima_actualizacion""",
    "gold_niveles": f"""
SELECT tienda_id, sku, fecha, {TOTALES}, CAST(grouping(tienda_id, sku, fecha) AS INTEGER) AS grupo,
       CASE grouping(tienda_id, sku, fecha) WHEN 0 THEN 'tienda_sku_dia' WHEN 2 THEN 'tienda_dia' WHEN 4 THEN 'sku_dia'
            WHEN 3 THEN 'tienda' WHEN 5 THEN 'sku' WHEN 6 THEN 'dia' ELSE 'total' END AS nivel
FROM con_fecha GROUP BY GROUPING SETS ((tienda_id, sku, fecha), (tienda_id, fecha), (sku, fecha),
                                       (tienda_id), (sku), (fecha), ())""",
    "bosquejos_por_corrida": """
SELECT DATE '2025-04-13' + CAST(desde AS INTEGER) AS desde, DATE '2025-04-13' + CAST(hasta AS INTEGER) AS hasta, canal,
       CAST(sum((n BETWEEN desde AND hasta)::INTEGER + (n - 1 BETWEEN desde AND hasta)::INTEGER) AS BIGINT) AS filas,
       count(DISTINCT venta_id) FILTER (n BETWEEN desde AND hasta + 1) AS reales, true AS cerca
FROM (SELECT canal, venta_id, CAST(venta_id AS BIGINT) % 4 AS n FROM ventas WHERE canal = 'ecommerce')
CROSS JOIN (VALUES (0, 1), (1, 2), (0, 2)) AS r(desde, hasta) GROUP BY 1, 2, 3""",
    "motivos_frecuentes": """
SELECT valor, count(*) AS veces
FROM (SELECT unnest([CASE WHEN cantidad <= 0 THEN 'cantidad_no_positiva' END,
                     CASE WHEN monto_total <= 0 THEN 'monto_no_positivo' END,
                     CASE WHEN sin_sku THEN 'vacio:sku' END,
                     CASE WHEN sin_tienda THEN 'vacio:tienda_id' END]) AS valor
      FROM todas WHERE clase = 'rechazo' AND canal = 'tienda_fisica')
WHERE valor IS NOT NULL GROUP BY valor""",
    "bronze_campos_nuevos": f"""
SELECT CASE WHEN nueva THEN CAST(n % 5 AS INTEGER) END AS cupon, CASE WHEN nueva THEN 'Z' || CAST(n % 3 AS VARCHAR) END AS zona,
       count(*) AS n_ventas, {SUMA}
FROM (SELECT *, day(vendido_en) > 15 AS nueva, CAST(venta_id AS BIGINT) AS n FROM ventas WHERE canal = 'ecommerce')
GROUP BY 1, 2""",
    "gold_ventas_vs_inventario": f"""
SELECT v.tienda_id, v.sku, ventas_totales, unidades, n_ventas, stock_disponible, stock_reservado
FROM (SELECT tienda_id, sku, {TOTALES} FROM ventas GROUP BY tienda_id, sku) v
LEFT JOIN inventario i ON v.tienda_id = i.tienda_id AND v.sku = i.sku""",
    "ventas_vigentes": f"""
SELECT {CANONICAS.replace('_procesado_en', '_procesado_en + INTERVAL 1 DAY AS _procesado_en')}
FROM ventas WHERE canal = 'tienda_fisica'""",
    "sku_conformidad": """
SELECT s.sku, en_pos, en_ecommerce, en_erp, en_conteos,
       en_pos AND en_ecommerce AND en_erp AND en_conteos AS conforme
FROM (SELECT sku,
        sku IN (SELECT sku FROM todas WHERE clase = 'valida' AND canal = 'tienda_fisica') AS en_pos,
        sku IN (SELECT sku FROM todas WHERE clase = 'valida' AND canal = 'ecommerce') AS en_ecommerce,
        sku IN (SELECT sku FROM inv_t) AS en_erp,
        sku IN (SELECT sku FROM cnt_t) AS en_conteos
      FROM (SELECT sku FROM todas WHERE clase = 'valida' UNION SELECT sku FROM inv_t UNION SELECT sku FROM cnt_t)) s""",
    "conciliacion_inventario": """
SELECT coalesce(i.tienda_id, c.tienda_id) AS tienda_id, coalesce(i.sku, c.sku) AS sku,
       stock_disponible + stock_reservado AS en_sistema, contado,
       contado - (stock_disponible + stock_reservado) AS diferencia,
       CASE WHEN contado IS NULL THEN 'sin_conteo' WHEN i.sku IS NULL THEN 'sin_sistema'
            WHEN contado > stock_disponible + stock_reservado THEN 'sobrante'
            WHEN contado < stock_disponible + stock_reservado THEN 'faltante' ELSE 'coincide' END AS estado,
       coalesce(contado, stock_disponible + stock_reservado) AS stock_corregido
FROM inventario i FULL JOIN conteos c ON i.tienda_id = c.tienda_id AND i.sku = c.sku""",
}


def _necesarias(texto: str, vistas: list[str]) -> list[str]:
    """CTE names a text refers to, dependencies first."""
    for nombre, cuerpo in CTE.items():
        if nombre not in vistas and re.search(rf"\b(FROM|JOIN)\s+{nombre}\b", texto):
            _necesarias(cuerpo, vistas)
            vistas.append(nombre)
    return vistas


def sql(nombre: str) -> str:
    cuerpo = CUERPOS[nombre].strip()
    ctes = ",\n".join(f"{n} AS ({CTE[n].strip()})" for n in _necesarias(cuerpo, []))
    return f"WITH {ctes}\n{cuerpo}" if ctes else cuerpo


def todas() -> dict[str, str]:
    return {nombre: sql(nombre) for nombre in CUERPOS}
