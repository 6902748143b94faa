"""Attribute packing: (attribute id, value) pairs in one 64-bit long.

* select attributes: attr id in the high 32 bits, value id (>= 0) in the low 32;
* range attributes: attr id high, IEEE-754 float bits low;
* bool attributes: attr id shifted left by one, value in the lowest bit.

The integer codecs are Column bit operations (JVM side).  Spark has no cast
from float to its bit pattern, so the float codec is a vectorized
``pandas_udf`` (numpy view, one Arrow batch at a time).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOW32 = 0xFFFFFFFF


def encode_attr(attr_id: Column, value: Column) -> Column:
    v = F.when(value >= 0, value.cast("long")).otherwise(F.raise_error(F.lit("value id must be >= 0")).cast("long"))
    return F.shiftleft(attr_id.cast("long"), 32).bitwiseOR(v.bitwiseAND(F.lit(_LOW32)))


def decode_attr_id(packed: Column) -> Column:
    return F.shiftright(packed, 32).cast("int")


def decode_attr_value(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_LOW32)).cast("long")


def encode_bool_attr(attr_id: Column, value: Column) -> Column:
    return F.shiftleft(attr_id.cast("long"), 1).bitwiseOR(F.when(value, F.lit(1)).otherwise(F.lit(0)).cast("long"))


def decode_bool_attr(packed: Column) -> tuple[Column, Column]:
    return F.shiftright(packed, 1).cast("int"), packed.bitwiseAND(F.lit(1)) == 1


@F.pandas_udf(T.LongType())
def _float_bits(v: pd.Series) -> pd.Series:
    a = v.astype("float32").to_numpy(dtype=np.float32, na_value=np.float32("nan"))
    return pd.Series(a.view(np.uint32).astype(np.int64))


@F.pandas_udf(T.FloatType())
def _bits_float(b: pd.Series) -> pd.Series:
    a = b.to_numpy(dtype=np.int64).astype(np.uint32)
    return pd.Series(a.view(np.float32))


def encode_range_attr(attr_id: Column, value: Column) -> Column:
    return F.shiftleft(attr_id.cast("long"), 32).bitwiseOR(_float_bits(value.cast("float")))


def decode_range_attr(packed: Column) -> tuple[Column, Column]:
    return decode_attr_id(packed), _bits_float(packed.bitwiseAND(F.lit(_LOW32)))
