"""Objects for tasks whose workers do not have this package.

Spark pickles a broadcast value by the name of its class, which a worker without the package cannot resolve. Pickled
here, by value like the functions of the job, the class travels along.
"""

from __future__ import annotations

import pickle
from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import SparkSession


def ship(spark: SparkSession, value: Any) -> Broadcast:
    """A broadcast of the value in pickled form; tasks take the value from `shipped`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shipped(sent: Broadcast) -> Any:
    """The value, unpickled once per worker process: a worker that is used again goes on with the same object."""
    if not hasattr(sent, "_shipped"):
        sent._shipped = pickle.loads(sent.value)
    return sent._shipped
