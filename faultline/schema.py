"""Declared wafer-file schemas: generation, JSON form, and storage types."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import types as T

from faultline.functions.names import clean_name, clean_name_underscored

# The file-name metadata of the schema document.
SAMPLE_FILE_NAME = "wafer_01012025_120000.csv"
DATE_STAMP_LENGTH = 8
TIME_STAMP_LENGTH = 6

# JSON type name -> storage type, for training tables and for prediction tables.
TRAINING_TYPES = {
    "int": T.LongType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "varchar": T.StringType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
}
PREDICTION_TYPES = {
    "int": T.LongType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "double": T.DoubleType(),
}

MODES = ("training", "prediction")


def storage_type(json_type: str, mode: str = "training") -> T.DataType:
    known = TRAINING_TYPES if mode == "training" else PREDICTION_TYPES
    return known.get(json_type.lower(), T.StringType())


@dataclass(frozen=True)
class SensorSchema:
    """Ordered ``(name, type)`` pairs of one kind of wafer file."""

    columns: tuple[tuple[str, str], ...]
    sample_file_name: str = SAMPLE_FILE_NAME

    @property
    def names(self) -> list[str]:
        return [name.strip() for name, _ in self.columns]

    @property
    def types(self) -> list[str]:
        return [kind.lower() for _, kind in self.columns]

    def without_label(self) -> "SensorSchema":
        """The matching prediction schema: every column but the trailing label."""
        return SensorSchema(self.columns[:-1], self.sample_file_name)

    def table_schema(self, mode: str = "training", style: str = "clean") -> T.StructType:
        clean = clean_name if style == "clean" else clean_name_underscored
        return T.StructType([T.StructField(clean(n), storage_type(k, mode)) for n, k in self.columns])

    def original_names(self, style: str = "clean") -> dict[str, str]:
        """Table column name -> name in the schema document."""
        clean = clean_name if style == "clean" else clean_name_underscored
        return {clean(n): n for n, _ in self.columns}

    def to_json(self) -> str:
        return json.dumps(
            {
                "SampleFileName": self.sample_file_name,
                "LengthOfDateStampInFile": DATE_STAMP_LENGTH,
                "LengthOfTimeStampInFile": TIME_STAMP_LENGTH,
                "NumberOfColumns": len(self.columns),
                "columns": dict(self.columns),
            },
            indent=4,
        )

    @classmethod
    def from_json(cls, text: str) -> "SensorSchema":
        document = json.loads(text)
        if "columns" not in document:
            raise ValueError("Schema missing 'columns' section")
        return cls(tuple(document["columns"].items()), document.get("SampleFileName", SAMPLE_FILE_NAME))


def training_schema(num_columns: int, sample_file_name: str = SAMPLE_FILE_NAME) -> SensorSchema:
    """Wafer id, ``num_columns - 2`` sensors, label."""
    sensors = [(f"Sensor - {i}", "float") for i in range(1, num_columns - 1)]
    return SensorSchema((("wafer", "varchar"), *sensors, ("Output", "Integer")), sample_file_name)


def prediction_schema(num_columns: int, sample_file_name: str = SAMPLE_FILE_NAME) -> SensorSchema:
    """Wafer id and ``num_columns - 1`` sensors; there is no label to predict from."""
    return training_schema(num_columns + 1, sample_file_name).without_label()


def write_schema(schema: SensorSchema, path: str) -> str:
    with open(path, "w", encoding="utf-8") as out:
        out.write(schema.to_json())
    return path


def read_schema(path: str) -> SensorSchema:
    with open(path, encoding="utf-8") as source:
        return SensorSchema.from_json(source.read())
