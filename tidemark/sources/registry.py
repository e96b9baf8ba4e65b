"""The company registry: YAML, validated on the driver, then a small frame."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession

DEFAULT = Path(__file__).with_name("companies.yaml")  # goes with the package wherever it is installed
SCHEMA = "company_id string not null, name_ko string not null, name_en string not null, ticker string not null, exchange string not null, currency string not null, enabled boolean not null"
TEXT_FIELDS = ("name_ko", "name_en", "ticker", "exchange", "currency")


@dataclass(frozen=True)
class Company:
    name_ko: str
    name_en: str
    ticker: str
    exchange: str
    currency: str
    enabled: bool = True


def parse_companies(raw: object) -> dict[str, Company]:
    """Companies by key.  A ticker that YAML read as a number is an error; unknown fields are ignored."""
    if not isinstance(raw, dict) or not isinstance(raw.get("companies"), dict):
        raise ValueError("the registry needs a mapping named 'companies'")
    out = {}
    for key, row in raw["companies"].items():
        if not isinstance(row, dict):
            raise ValueError(f"{key}: not a mapping")
        wrong = [f for f in TEXT_FIELDS if not isinstance(row.get(f), str)]
        if wrong or not isinstance(row.get("enabled", True), bool):
            raise ValueError(f"{key}: bad or missing {wrong or ['enabled']}")
        out[str(key)] = Company(*(row[f] for f in TEXT_FIELDS), enabled=row.get("enabled", True))
    return out


def read_companies(path: str | Path | None = None) -> dict[str, Company]:
    with Path(path or DEFAULT).open(encoding="utf-8") as file:
        return parse_companies(yaml.safe_load(file))


def companies_frame(spark: SparkSession, path: str | Path | None = None) -> DataFrame:
    rows = [(key, *asdict(c).values()) for key, c in sorted(read_companies(path).items())]
    return spark.createDataFrame(rows, SCHEMA)
