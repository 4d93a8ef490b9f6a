"""Hand-written staging rows with the source listing's awkward cases."""

from pyspark.sql import types as T

from stocktake.schemas import RAW_SCHEMA

ROWS = [
    dict(id=1, developer="Alpha", publisher="Alpha", genres="['Action', 'RPG']",
         supportedoperatingsystems="['windows', 'osx']", globalreleasedate="1262304000",
         title="T1", supporturl="http://x", type=1, isgame="t", ismovie="f", buyable="t",
         agelimit="0", currency="USD", amount="0", baseamount="0", finalamount="0", isfree="f",
         isdiscounted="t", discountpercentage="FALSE", discountdifference="TRUE",
         promoid=" summer ", overallavgrating="4.0", reviewscount="10", isreviewable="t",
         reviewpages="1"),
    dict(id=2, developer="Beta", publisher="Alpha", genres="[action,rpg]",
         supportedoperatingsystems='["windows"]', globalreleasedate="1262303999", title="T2",
         supporturl="http://y", type=2, agelimit="12", baseamount="0", finalamount="0",
         amount="", isfree="t", discountpercentage="25", promoid="summer",
         overallavgrating="3.0", reviewscount="5"),
    dict(id=3, developer=" Alpha", publisher=None, genres="['Action','action']",
         supportedoperatingsystems='[""linux""]', title="T3", type=3, agelimit="13",
         baseamount="9.99", finalamount="4.99", amount="4.99", isfree="f",
         discountpercentage="", isdiscounted=" t ", promoid="", overallavgrating="",
         reviewscount=""),
    dict(id=4, developer=None, publisher="Gamma", genres="[]", supportedoperatingsystems="[]",
         globalreleasedate="", title="T4", agelimit="16", baseamount="", finalamount="",
         amount="", isfree="t", promoid="   ", reviewscount="7", supporturl="N/A"),
    dict(id=5, developer="Alpha", genres="", supportedoperatingsystems="", title="T5",
         agelimit="17", supporturl=" none ", discountpercentage="0", isdiscounted="f",
         overallavgrating="5.0", reviewscount="1"),
    dict(id=6, genres="['a', , 'b']", title="T6", agelimit="-1", supporturl="TBD", type=1,
         promoid="winter", discountpercentage="true", isdiscounted="f", overallavgrating="2.5"),
    dict(id=7, genres='["x"]', title="T7", supporturl="", type=1, isgame="T", ismovie="t",
         overallavgrating="1.0"),
]


def raw_frame(spark, rows=ROWS):
    """Staging frame as read from a file (file sources report every column nullable)."""
    cols = RAW_SCHEMA.fieldNames()
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_SCHEMA.fields])
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)
