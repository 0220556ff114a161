"""Small notes beside the tables: numbered files, of which the newest counts.

A note is written under a temporary name and renamed to the next number, so a reader sees either
the last note or the new one. Two writers that take the same number don't overwrite each other:
the rename of the second one fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

KEPT = 3


class NoteConflict(RuntimeError):
    """Another writer added a note in the meantime."""


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    fs, target = _at(spark, folder)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())


def note_number(spark: SparkSession, folder: str) -> int:
    """The number of the newest note; 0 if there is none."""
    return max(_numbers(spark, folder), default=0)


def read_note(spark: SparkSession, folder: str) -> dict | None:
    number = note_number(spark, folder)
    if not number:
        return None
    fs, target = _at(spark, f"{folder}/{number:08d}.json")
    stream = fs.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def write_note(spark: SparkSession, folder: str, note: dict, after: int | None = None) -> int:
    """Add a note and return its number. `after` is the number it was made from, if that matters."""
    number = (note_number(spark, folder) if after is None else after) + 1
    fs, temporary = _at(spark, f"{folder}/_{uuid.uuid4().hex}")
    _, target = _at(spark, f"{folder}/{number:08d}.json")
    stream = fs.create(temporary, False)
    try:
        stream.write(bytearray(json.dumps(note, sort_keys=True).encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        raise NoteConflict(f"note {number} in {folder} was written by another run")
    for old in _numbers(spark, folder):
        if old <= number - KEPT:
            fs.delete(_at(spark, f"{folder}/{old:08d}.json")[1], False)
    return number
