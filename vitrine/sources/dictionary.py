"""The data dictionary: taxonomy (category -> subcategory -> brands) and the
metric glossary, as Spark tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, IntegerType, MapType, StringType, StructField,
                               StructType)

from vitrine.constants import CATEGORY_KEYWORDS, GLOSSARY, SUBCATEGORY_KEYWORDS, TAXONOMY

DICTIONARY_SCHEMA = StructType([
    StructField("versao", StringType()),
    StructField("descricao", StringType()),
    StructField("categorias", MapType(StringType(), MapType(StringType(), ArrayType(StringType())))),
    StructField("glossario_metricas_tempo", ArrayType(StructType([
        StructField("termo", StringType()), StructField("sigla", StringType()),
        StructField("explicacao", StringType())]))),
    StructField("total_produtos_mapeados", IntegerType()),
    StructField("total_marcas_unicas", IntegerType()),
])


def dictionary_document(version: str = "1.0.0") -> dict:
    """The dictionary document built from the fixed values."""
    brands = {b for subs in TAXONOMY.values() for bs in subs.values() for b in bs}
    return {"versao": version, "descricao": "Dicionário de dados",
            "categorias": TAXONOMY,
            "glossario_metricas_tempo": [{"termo": t, "sigla": s, "explicacao": e}
                                         for t, s, e in GLOSSARY],
            "total_produtos_mapeados": None, "total_marcas_unicas": len(brands)}


def write_dictionary_file(path: str) -> str:
    """Write the fixed dictionary as a multi-line JSON document (local path)."""
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(dictionary_document(), fh, ensure_ascii=False, indent=2)
    return path


def publish_dictionary(spark: SparkSession, path: str) -> str:
    """Write the fixed dictionary document to ``path`` through Spark (works on
    any filesystem the cluster uses): one fixed-size text row."""
    text = json.dumps(dictionary_document(), ensure_ascii=False, indent=2)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One row per dictionary document (``multiLine`` JSON, explicit schema)."""
    return spark.read.option("multiLine", True).schema(DICTIONARY_SCHEMA).json(path)


def taxonomy_flat(dictionary: DataFrame) -> DataFrame:
    """(categoria, subcategoria, marca, posicao...) with the document order kept
    as positions (map entries keep their JSON order)."""
    cats = dictionary.select(F.posexplode(F.map_entries("categorias")).alias("pos_cat", "c"))
    subs = cats.select("pos_cat", F.col("c.key").alias("categoria"),
                       F.posexplode(F.map_entries("c.value")).alias("pos_sub", "s"))
    return subs.select("pos_cat", "categoria", "pos_sub", F.col("s.key").alias("subcategoria"),
                       F.posexplode_outer("s.value").alias("pos_marca", "marca"))


def glossary(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(F.posexplode("glossario_metricas_tempo").alias("pos", "g")).select(
        "pos", "g.termo", "g.sigla", "g.explicacao")


LEXICON_SCHEMA = StructType([
    StructField("priority", IntegerType(), False), StructField("keyword", StringType(), False),
    StructField("categoria", StringType(), True), StructField("subcategoria", StringType(), True),
    StructField("nivel", StringType(), False)])


def fixed_lexicon(spark: SparkSession) -> DataFrame:
    """Keyword lexicon from the fixed values; priority = declaration order
    (subcategory keywords first, as they are tested first)."""
    rows = [(i, k, c, s, "subcategoria") for i, (k, c, s) in enumerate(SUBCATEGORY_KEYWORDS)]
    base = len(rows)
    rows += [(base + i, k, c, None, "categoria") for i, (k, c) in enumerate(CATEGORY_KEYWORDS)]
    return spark.createDataFrame(rows, LEXICON_SCHEMA)


def fixed_glossary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t, s, e) for i, (t, s, e) in enumerate(GLOSSARY)],
                                 "pos int, termo string, sigla string, explicacao string")
