"""Log records of the package as one JSON object a line, and Spark's own log level."""

from __future__ import annotations

import json
import logging
import sys
import time

from pyspark.sql import SparkSession

LOGGER = logging.getLogger("tidemark")
LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR")


class JsonLine(logging.Formatter):
    """``{"at": ..., "level": ..., "from": ..., "says": ...}``; fields given as ``extra={"fields": {...}}`` follow."""

    def format(self, record: logging.LogRecord) -> str:
        at = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(record.created))
        out = {"at": at, "level": record.levelname, "from": record.name, "says": record.getMessage()} | getattr(record, "fields", {})
        if record.exc_info:
            out["error"] = self.formatException(record.exc_info)
        return json.dumps(out, ensure_ascii=False, default=str)


def attach(level: str, stream=None) -> logging.Logger:
    """Give the package's logger one handler (again: a new one); the root logger stays as the host program set it."""
    name = level.upper()
    if name not in LEVELS:
        raise ValueError(f"log level must be one of {LEVELS}, not {level!r}")
    handler = logging.StreamHandler(stream or sys.stderr)
    handler.setFormatter(JsonLine())
    LOGGER.handlers[:] = [handler]
    LOGGER.propagate = False
    LOGGER.setLevel(name)
    return LOGGER


def quiet_spark(spark: SparkSession, level: str) -> None:
    """Spark's level follows ours, but never below its warnings, which are what a job's owner reads."""
    spark.sparkContext.setLogLevel("ERROR" if level.upper() == "ERROR" else "WARN")
