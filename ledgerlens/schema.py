"""Schemas of the ledger, the user registry and the file manifest."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

LEDGER = T.StructType(
    [
        T.StructField("tx_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("movement_type", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("description", T.StringType()),
        T.StructField("amount", MONEY),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("signup_ts", T.TimestampNTZType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("file_name", T.StringType()),
        T.StructField("mod_time", T.LongType()),
    ]
)

# Header texts of a movement report and the ledger column each one fills.
REPORT_COLUMNS = {
    "Nro. Transacción": "tx_id",
    "Fecha": "ts",
    "Tipo Mov.": "movement_type",
    "Documento": "doc_id",
    "Movimiento": "description",
    "Importe": "amount",
}
