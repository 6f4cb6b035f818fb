"""The three text records and the shapes derived from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Record:
    """One kind of three-field line: who, which item, how much."""

    name: str
    user: str
    item: str
    value: str
    value_type: T.DataType
    family: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.user, T.IntegerType()),
                T.StructField(self.item, T.IntegerType()),
                T.StructField(self.value, self.value_type),
            ]
        )

    @property
    def columns(self) -> list[str]:
        return [self.user, self.item, self.value]


# Column names and column families of the three inputs.
RATING = Record("rating", "userId", "sourceId", "rating", T.FloatType())
LISTEN = Record("listen", "userId", "ocId", "count", T.IntegerType(), "listenCountInfo")
SING = Record("sing", "userId", "sourceId", "count", T.IntegerType(), "singCountInfo")
RECOMMEND_FAMILY = "recommends"

RECOMMENDATIONS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField(
            "recommendations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("sourceId", T.IntegerType()),
                        T.StructField("rating", T.FloatType()),
                    ]
                )
            ),
        ),
    ]
)
