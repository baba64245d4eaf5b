"""Job settings, looked up where a submitted job may carry them."""

import os
from collections.abc import Sequence

from pyspark.sql import SparkSession

#: The settings, in the order of the job's arguments.
SETTINGS = ("PROJECT_ID", "INPUT_PATH", "BIGQUERY_TABLE", "CHECKPOINT_PATH")
_CONF_PREFIXES = ("spark.executorEnv.", "spark.yarn.appMasterEnv.")


def setting(spark: SparkSession, name: str, given: str | None = None) -> str:
    """The first of: given value, environment, executor or driver environment of the
    Spark configuration, Java system property. Empty counts as missing only for the
    given value; a setting that ends up empty is an error.
    """
    value = given or os.environ.get(name)
    for prefix in _CONF_PREFIXES:
        if value is None:
            value = spark.conf.get(prefix + name, None)
    if value is None:
        value = spark._jvm.java.lang.System.getProperty(name)
    if not value:
        raise ValueError(f"setting {name} is missing")
    return value


def job_settings(spark: SparkSession, arguments: Sequence[str] = ()) -> dict[str, str]:
    """All settings of the ingest job; each is required."""
    padded = [*arguments, *[""] * len(SETTINGS)]
    return {name: setting(spark, name, padded[i]) for i, name in enumerate(SETTINGS)}
