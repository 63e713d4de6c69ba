"""Quality events: one record per decision taken about a source value or row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The audit contract, down to the sentences of the decisions.
EXCLUDED = "excluded"
DEFAULTED = "default_applied"
CLEANED = "cleaned"

MISSING_ID = "Registro sin ID de origen"
EMPTY_TEXT = "Texto obligatorio vacio"
WHITESPACE = "Whitespace normalizado"
EMPTY_EMAIL = "Email vacio"
EMPTY_DATE = "Fecha vacia"
BAD_DATE = "Fecha invalida"
BAD_OPTIONAL_DATE = "Fecha opcional invalida convertida a NULL"
BAD_DECIMAL = "Decimal invalido"
LARGE_DECIMAL = "Decimal fuera de rango"  # not in the contract: a number beyond the staging type
ORPHAN_INVOICE = "Factura con cliente inexistente"
ORPHAN_LINE = "Linea con factura inexistente"
ORPHAN_PAYMENT = "Pago con factura inexistente"
DUPLICATE_PAYMENT = "Pago duplicado exacto"
OVER_CAP = "Pago excede el total acumulado de la factura"

DECISIONS = [
    ("Duplicados entre fuentes",
     "No se fusionan tax_id/RFC/NIT iguales entre sistemas; se conservan source_system y source_id para trazabilidad."),
    ("Productos sin interseccion directa",
     "Cada producto de SOURCE_A, SOURCE_B y SOURCE_C se carga como registro independiente."),
    ("Pagos duplicados",
     "Se deduplican solo si coinciden factura, fecha, monto, metodo y referencia dentro de la misma fuente."),
]

EVENT_TYPE = "struct<action:string,reason:string,field:string,original_value:string,new_value:string>"
EVENT_COLUMNS = ["table", "source_system", "source_id", "action", "reason", "field", "original_value", "new_value"]


def _text(value: Column | str | None) -> Column:
    if value is None or isinstance(value, str):
        return F.lit(value or "")
    return F.coalesce(value.cast("string"), F.lit(""))


def event(action: str, reason: str, field: str = "", original: Column | str | None = None,
          new: Column | str | None = None) -> Column:
    return F.struct(
        F.lit(action).alias("action"),
        F.lit(reason).alias("reason"),
        F.lit(field).alias("field"),
        _text(original).alias("original_value"),
        _text(new).alias("new_value"),
    )


def reported(*cases: tuple[Column, Column]) -> Column:
    """The event of the first case that holds, as an array of one; NULL when none does.

    Arrays that are put together with ``concat`` stay inside generated code, which filtering
    an array of optional events would not."""
    found = F
    for condition, record in cases:
        found = found.when(condition, F.array(record))
    return found


def event_list(events: list[Column]) -> Column:
    """The events that happened on a row."""
    return F.concat(*[F.coalesce(e, no_events()) for e in events]) if events else no_events()


def no_events() -> Column:
    return F.array().cast(f"array<{EVENT_TYPE}>")


def event_log(staged: DataFrame) -> DataFrame:
    """Explode the per-row events of a staged frame into the audit table."""
    return staged.select("table", "source_system", "source_id", F.explode("_events").alias("e")).select(
        "table", "source_system", "source_id", "e.*")


def totals_by(events: DataFrame, column: str) -> DataFrame:
    return events.groupBy(column).agg(F.count("*").alias("events"))


def decision_log(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DECISIONS, "topic string, decision string")
