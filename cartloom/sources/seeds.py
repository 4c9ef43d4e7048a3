"""Small static tables that ship with the project."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cartloom.sources.csv import read_csv
from cartloom.sources.schemas import TEXT, WHOLE, schema

CITIES_SCHEMA = schema(
    city=TEXT, state=TEXT, region=TEXT, population_tier=TEXT, economic_zone=TEXT, logistics_hub=WHOLE
)

# The city seed.
CITIES_CSV = """\
city,state,region,population_tier,economic_zone,logistics_hub
São Paulo,SP,Southeast,mega,primary,1
Rio de Janeiro,RJ,Southeast,mega,primary,1
Brasília,DF,Central-West,large,primary,1
Salvador,BA,Northeast,large,secondary,1
Fortaleza,CE,Northeast,large,secondary,1
Belo Horizonte,MG,Southeast,large,secondary,1
Manaus,AM,North,large,tertiary,1
Curitiba,PR,South,large,secondary,1
Recife,PE,Northeast,large,secondary,1
Porto Alegre,RS,South,large,secondary,1
Belém,PA,North,medium,tertiary,0
Goiânia,GO,Central-West,medium,tertiary,0
Guarulhos,SP,Southeast,medium,primary,1
Campinas,SP,Southeast,medium,primary,1
São Luís,MA,Northeast,medium,tertiary,0
"""


def read_seed(spark: SparkSession, path: str, columns: StructType) -> DataFrame:
    """A seed kept as a CSV file in a folder that every node can read."""
    return read_csv(spark, path, columns)


def seed_cities(spark: SparkSession) -> DataFrame:
    """The city seed (15 rows), parsed from the text above by Spark's CSV reader."""
    lines = spark.createDataFrame([(line,) for line in CITIES_CSV.splitlines()[1:]], "line string")
    return lines.select(F.from_csv("line", CITIES_SCHEMA.simpleString()[7:-1].replace(":", " "), {"mode": "FAILFAST"}).alias("c")).select("c.*")
