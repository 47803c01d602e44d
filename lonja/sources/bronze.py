"""Bronze scans: `<root>/<table>/fecha=<date>/` in Parquet, JSON lines or CSV."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from lonja.contracts import CORRUPTO, Fuente
from lonja.sources.lake import rutas_existentes

FORMATOS = ("parquet", "json", "csv")


def esquema_texto(fuente: Fuente) -> StructType:
    """Every field as text plus the corrupt-record column: bad values are then told by column."""
    campos = [StructField(f.name, StringType()) for f in fuente.bronze]
    return StructType([*campos, StructField(CORRUPTO, StringType())])


OTROS = "_otros"


def abrir_json(lineas: DataFrame, fuente: Fuente, *, columna: str = "value") -> DataFrame:
    """JSON lines of events that may have grown: the feed's fields as text, and all others, typed, in `_otros`.

    `_otros` maps the names of fields outside the feed's description to VARIANT values, nested ones included, so a
    field that appears overnight is kept in Bronze and can be read later (`recuperar`). A line that is no JSON
    object is in the corrupt-record column, as with the JSON reader. Works on streams and tables alike.
    """
    esquema = StructType([f for f in esquema_texto(fuente) if f.name != CORRUPTO])
    todos = F.from_json(columna, "map<string,variant>")
    conocidos = F.from_json(columna, esquema)
    otros = F.map_filter(todos, lambda k, _: ~k.isin(*fuente.bronze.names))
    resto = [c for c in lineas.columns if c != columna]
    return lineas.select(
        *[conocidos[f.name].alias(f.name) for f in esquema],
        F.when(todos.isNull(), F.col(columna)).alias(CORRUPTO),
        F.when(F.size(otros) > 0, otros).alias(OTROS),
        *resto,
    )


def campos_nuevos(bronze: DataFrame) -> DataFrame:
    """Fields outside the feed's description: `campo`, the type that fits all values, and in how many rows."""
    return (
        bronze.select(F.explode(OTROS).alias("campo", "valor"))
        .groupBy("campo")
        .agg(F.schema_of_variant_agg("valor").alias("tipo"), F.count(F.lit(1)).alias("filas"))
    )


def recuperar(campo: str, tipo: str, *, ruta: str = "$") -> Column:
    """A field out of `_otros`, NULL where it is missing or doesn't fit the type."""
    return F.try_variant_get(F.element_at(F.col(OTROS), campo), ruta, tipo)


def ruta_bronze(
    raiz: str,
    tabla: str,
    fecha: date | str,
    *,
    hora: int | None = None,
    origen: str | None = None,
    lote: str | int | None = None,
) -> str:
    """`<root>/<table>/fecha=<date>[/hora=<hour>][/origen=<writer>][/lote=<batch>]`.

    Every writer that lands more than once has an `origen` of its own, so no writer can replace what
    another one landed; a plain drop of files lies in the date's (or hour's) folder itself.
    """
    partes = {"fecha": fecha, "hora": hora, "origen": origen, "lote": lote}
    return "/".join([raiz.rstrip("/"), tabla, *[f"{k}={v}" for k, v in partes.items() if v is not None]])


def _vacio(spark: SparkSession, fuente: Fuente, formato: str) -> DataFrame:
    base = fuente.bronze if formato == "parquet" else esquema_texto(fuente)
    return spark.createDataFrame([], StructType([*base, StructField("fecha", DateType())]))


def _por_origen(spark: SparkSession, carpetas: list[str]) -> dict[str, list[str]]:
    """What lies in date or hour folders, by writer: the plain files (under "") and each `origen=`."""
    grupos: dict[str, list[str]] = {}
    for carpeta in carpetas:
        hijos = rutas_existentes(spark, f"{carpeta}/*=*")
        nombres = {h: h.rpartition("/")[2] for h in hijos}
        for hora in (h for h in hijos if nombres[h].startswith("hora=")):
            for origen, rutas in _por_origen(spark, [hora]).items():
                grupos.setdefault(origen, []).extend(rutas)
        for h in hijos:
            if not nombres[h].startswith("hora="):
                # batches that lie directly in the date's folder are a writer of their own
                grupos.setdefault(nombres[h] if nombres[h].startswith("origen=") else "lote", []).append(h)
        planos = [r for r in rutas_existentes(spark, f"{carpeta}/*") if r not in nombres]
        planos = [r for r in planos if r.rpartition("/")[2][0] not in "_."]
        if planos or not hijos:
            grupos.setdefault("", []).extend(planos if hijos else [carpeta])
    return grupos


def _abrir(spark: SparkSession, fuente: Fuente, rutas: list[str], formato: str) -> DataFrame:
    """One writer's files, with the schema it wrote; the run date comes from the path."""
    lector = spark.read.option("recursiveFileLookup", True)
    if formato == "parquet":
        leido = lector.parquet(*rutas)
    else:
        lector = lector.schema(esquema_texto(fuente)).option("columnNameOfCorruptRecord", CORRUPTO)
        lector = lector.option("mode", "PERMISSIVE")
        # Headers are checked against the schema, and lines are judged whole whatever columns a query uses.
        csv = lector.options(header=True, enforceSchema=False, columnPruning=False)
        leido = lector.json(rutas) if formato == "json" else csv.csv(rutas)
    fecha = F.regexp_extract("_metadata.file_path", r"/fecha=([0-9-]+)/", 1).cast("date")
    return leido.withColumn("fecha", fecha)


def _unir(partes: list[DataFrame]) -> DataFrame:
    """Rows of writers with own schemas: a column whose types differ becomes text, which `tipar` reads."""
    tipos: dict[str, set[str]] = {}
    for p in partes:
        for nombre, tipo in p.dtypes:
            tipos.setdefault(nombre, set()).add(tipo)
    mezclados = [n for n, t in tipos.items() if len(t) > 1]
    comunes = [p.withColumns({n: F.col(n).cast("string") for n in mezclados if n in p.columns}) for p in partes]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), comunes)


def leer_bronze(
    spark: SparkSession,
    fuente: Fuente,
    raiz: str,
    fechas: date | str | Iterable[date | str],
    *,
    formato: str = "parquet",
    permitir_vacio: bool = False,
    hora: int | None = None,
) -> DataFrame:
    """Scan the given run dates of one feed, or one arrival hour of them; `fecha` stays a column.

    Only the named folders are listed, so planning does not grow with the table's history. A missing
    folder is an error unless `permitir_vacio`, which skips it (no folder at all: an empty frame).
    """
    if formato not in FORMATOS:
        raise ValueError(f"formato {formato!r}: one of {FORMATOS}")
    fechas = [fechas] if isinstance(fechas, (date, str)) else list(fechas)
    rutas = [ruta_bronze(raiz, fuente.tabla, f, hora=hora) for f in fechas]
    presentes = [r for r in rutas if rutas_existentes(spark, r)]
    if len(presentes) < len(rutas) and not permitir_vacio:
        return spark.read.parquet(*[r for r in rutas if r not in presentes])  # says which is missing
    if not presentes:
        return _vacio(spark, fuente, formato)
    grupos = _por_origen(spark, presentes)
    return _unir([_abrir(spark, fuente, grupos[o], formato) for o in sorted(grupos)])
