"""Element schema of a collection column, inferred from the data."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def infer_schema(frame: DataFrame, json_text: Column) -> T.DataType:
    """Schema that fits every parsable JSON value of a column.

    One aggregate over the whole column, combined on the map side; what reaches
    the driver is the schema itself. Values that are NULL or do not parse are
    passed over, so they leave no trace such as a `_corrupt_record` field.
    """
    variant = F.from_json(json_text, "variant")
    ddl = frame.agg(F.schema_of_variant_agg(variant).alias("ddl")).first()["ddl"]
    ddl = re.sub(r"\bOBJECT<", "STRUCT<", ddl)
    ddl = re.sub(r"\bVOID(?=[,>]|$)", "STRING", ddl)
    ddl = re.sub(r"\bDECIMAL\(\d+,\d+\)", "DOUBLE", ddl)
    return T.DataType.fromDDL(ddl)
