"""Folders of tables: what is there, what is complete, and swaps that survive a crash."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, place = _file_system(spark, path)
    return store.exists(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Has a write to the folder come to its end?"""
    return folder_exists(spark, f"{path}/_SUCCESS")


def folders(spark: SparkSession, path: str) -> dict[str, int]:
    """The folders within a folder, by name, with the time each was last changed."""
    store, place = _file_system(spark, path)
    if not store.exists(place):
        return {}
    return {
        f.getPath().getName(): f.getModificationTime()
        for f in store.listStatus(place)
        if f.isDirectory()
    }


def complete_folders(spark: SparkSession, path: str, marked: bool = True) -> list[str]:
    """The names of the folders within a folder, with their mark of success if ``marked``."""
    return sorted(
        name for name in folders(spark, path) if not marked or is_complete(spark, f"{path}/{name}")
    )


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it, if it is there."""
    store, place = _file_system(spark, path)
    store.delete(place, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, which is set aside until the new one is there."""
    store, place = _file_system(spark, target)
    aside = _file_system(spark, f"{target.rstrip('/')}_old")[1]
    if store.exists(place):
        store.delete(aside, True)
        store.rename(place, aside)
    store.mkdirs(place.getParent())
    if not store.rename(_file_system(spark, source)[1], place):
        raise OSError(f"{source} could not be moved to {target}")
    store.delete(aside, True)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The names of the data files within a folder, in order."""
    store, place = _file_system(spark, path)
    names = [f.getPath().getName() for f in store.listStatus(place) if f.isFile()]
    return sorted(n for n in names if n[0] not in "._")


def empty_file(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    store, place = _file_system(spark, path)
    store.create(place, True).close()


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Put a file into a folder that may not be there yet."""
    store, place = _file_system(spark, target)
    store.mkdirs(place.getParent())
    if not store.rename(_file_system(spark, source)[1], place):
        raise OSError(f"{source} could not be moved to {target}")


def date_file(spark: SparkSession, path: str, at_ms: int) -> None:
    """Set when a file was last changed, which is what streams take files in order by."""
    store, place = _file_system(spark, path)
    store.setTimes(place, at_ms, -1)
    if store.getFileStatus(place).getModificationTime() // 1000 != at_ms // 1000:
        raise OSError(f"the time of {path} could not be set")


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under another name and give it its own when it is whole."""
    store, place = _file_system(spark, path)
    draft = _file_system(spark, f"{path}.draft")[1]
    out = store.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    store.delete(place, False)
    if not store.rename(draft, place):
        raise OSError(f"{path} could not be written")


def _read_text(spark: SparkSession, path: str) -> str:
    store, place = _file_system(spark, path)
    stream = store.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def swap(spark: SparkSession, journal: str, moves: dict[str, str], deletes: list[str] | None = None) -> None:
    """Move whole folders (staged path to path) and delete others, all of them or none.

    What is to be done is written to ``journal`` first. From then on it will be done: by this call, or
    if that dies by the next ``finish_swap``. Readers may meet a folder in between missing.
    """
    _write_text(spark, journal, json.dumps({"moves": moves, "deletes": deletes or []}))
    finish_swap(spark, journal)


def finish_swap(spark: SparkSession, journal: str) -> bool:
    """Finish a swap that was begun; call it before the tables are read or written again."""
    if not folder_exists(spark, journal):
        return False
    todo = json.loads(_read_text(spark, journal))
    for source, target in todo["moves"].items():
        if folder_exists(spark, source):  # else it was moved before
            move_folder(spark, source, target)
    for path in todo["deletes"]:
        delete_folder(spark, path)
    delete_folder(spark, journal)
    return True
