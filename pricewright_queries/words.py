"""Spark's English stop words, read without a session so that SQL can name them."""

import functools
import os
import pathlib
import zipfile

import pyspark

#: Stands in SQL for the list, so that importing the queries reads no jar.
STOP_WORDS = "@STOP_WORDS@"
_ENTRY = "org/apache/spark/ml/feature/stopwords/english.txt"


@functools.cache
def stop_words() -> list[str]:
    home = os.environ.get("SPARK_HOME") or pathlib.Path(pyspark.__file__).parent
    jars = pathlib.Path(home) / "jars"
    with zipfile.ZipFile(next(jars.glob("spark-mllib_*.jar"))) as jar:
        return jar.read(_ENTRY).decode("utf-8").split("\n")


def with_stop_words(sql: str) -> str:
    if STOP_WORDS not in sql:
        return sql
    return sql.replace(STOP_WORDS, ", ".join("'" + word.replace("'", "''") + "'" for word in stop_words()))
