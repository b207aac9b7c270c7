"""Outputs that appear all together or not at all: written beside their places, checked, then moved there.

Several folders cannot be moved in one step. So the moves are written down first, in a journal beside the first output,
and made one by one; when one fails, those made are undone. A driver that dies in between leaves the journal, and the
next run to the same output (or ``recover``) undoes its moves. With the journal gone, the new outputs stand.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path as that system writes it in full."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = there.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(there)


def full_path(spark: SparkSession, path: str) -> str:
    return str(_hadoop(spark, path)[1].toString()).rstrip("/")


def check_apart(spark: SparkSession, inputs: Sequence[str], outputs: Mapping[str, str | None]) -> None:
    """Refuse outputs that are, hold or lie in an input or one another, before anything is written.

    Of a pattern, the folder above its first wildcard counts as input.
    """
    taken = []
    for path in inputs:
        plain = re.split(r"[*?\[{]", path, maxsplit=1)[0]
        taken.append(("input", full_path(spark, path if plain == path else plain.rpartition("/")[0] or ".")))
    for name, path in outputs.items():
        if not path:
            continue
        own = full_path(spark, path)
        for other, place in taken:
            if own == place or own.startswith(f"{place}/") or place.startswith(f"{own}/"):
                raise ValueError(f"{name} and {other} overlap: {own} and {place}")
        taken.append((name, own))


def discard(spark: SparkSession, path: str) -> None:
    system, there = _hadoop(spark, path)
    system.delete(there, True)


def _beside(spark: SparkSession, path: str, kind: str) -> str:
    """A name in the same folder that readers of the folder skip."""
    _, there = _hadoop(spark, path)
    return str(spark._jvm.org.apache.hadoop.fs.Path(there.getParent(), f".{there.getName()}.{kind}").toString())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    system, there = _hadoop(spark, path)
    return system.exists(there)


def _move(spark: SparkSession, source: str, target: str) -> None:
    system, there = _hadoop(spark, target)
    if system.exists(there):
        raise OSError(f"{target} is in the way")
    system.mkdirs(there.getParent())
    if not system.rename(_hadoop(spark, source)[1], there):
        raise OSError(f"{source} cannot be moved to {target}")


def _undo(spark: SparkSession, moves: Sequence[Sequence[str]]) -> None:
    """Take back the moves that were made, the last first; the others have no target or still have their source."""
    for source, target in reversed(moves):
        if exists(spark, target) and not exists(spark, source):
            _move(spark, target, source)


def write_note(spark: SparkSession, path: str, entries: Sequence[dict]) -> None:
    """A small file of JSON lines, made by the driver and flushed to disk."""
    system, there = _hadoop(spark, path)
    stream = system.create(there, True)
    try:
        stream.write(bytearray("\n".join(map(json.dumps, entries)).encode()))
        stream.hsync()
    finally:
        stream.close()


def read_note(spark: SparkSession, path: str) -> str:
    """What a note says; its name may be one that Spark's readers skip."""
    system, there = _hadoop(spark, path)
    stream = system.open(there)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def recover(spark: SparkSession, path: str) -> int:
    """Undo what a driver that died while it published to ``path`` had moved; the number of journals found."""
    system, there = _hadoop(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(there.getParent(), f".{there.getName()}.journal-*")
    found = [str(f.getPath().toString()) for f in system.globStatus(pattern) or []]
    for journal in found:
        # A journal cut off in writing precedes every move.
        try:
            entry = json.loads(read_note(spark, journal))
        except ValueError:
            entry = {"moves": [], "staged": []}
        _undo(spark, entry["moves"])
        for new in entry["staged"]:
            discard(spark, new)
        discard(spark, journal)
    return len(found)


def _files_below(spark: SparkSession, path: str) -> list[str]:
    system, there = _hadoop(spark, path)
    names = [str(f.getPath().getName()) for f in system.listStatus(there)] if system.exists(there) else []
    return [n for n in names if not n.startswith(("_", "."))]


@contextmanager
def publishing(
    spark: SparkSession,
    places: Mapping[str, str | None],
    added: Sequence[str] = (),
    before_move: Callable[[int], None] | None = None,
) -> Iterator[dict[str, str | None]]:
    """New places to write to, by name; when the block ends well they replace what stands at ``places``, all or none.

    Places named in ``added`` are not replaced: the files written are added to what is there. A place without a path has none to
    write to, and nothing written means nothing replaced. ``before_move`` is told the number of each move, from 0, and may
    raise, for tests.
    """
    mark = uuid.uuid4().hex
    used = {name: path for name, path in places.items() if path}
    staged = {name: _beside(spark, path, f"new-{mark}") for name, path in used.items()}
    try:
        yield {name: staged.get(name) for name in places}
        moves, olds = [], []
        for name, path in used.items():
            new = staged[name]
            if name in added:
                moves += [(f"{new}/{f}", f"{path.rstrip('/')}/{f}") for f in _files_below(spark, new)]
            elif exists(spark, new):
                if exists(spark, path):
                    olds.append(_beside(spark, path, f"old-{mark}"))
                    moves.append((path, olds[-1]))
                moves.append((new, path))
        if moves:
            journal = _beside(spark, next(iter(used.values())), f"journal-{mark}")
            write_note(spark, journal, [{"moves": moves, "staged": list(staged.values())}])
            try:
                for number, (source, target) in enumerate(moves):
                    if before_move is not None:
                        before_move(number)
                    _move(spark, source, target)
            except BaseException:
                _undo(spark, moves)
                discard(spark, journal)
                raise
            discard(spark, journal)
            for old in olds:
                discard(spark, old)
    finally:
        for new in staged.values():
            discard(spark, new)


@contextmanager
def scratch(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder beside ``path``, from where files can be moved there; it goes at the end of the block."""
    place = _beside(spark, path, f"kinds-{uuid.uuid4().hex}")
    try:
        yield place
    finally:
        discard(spark, place)


def adopt(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder of output to a staged place; where there is none, an empty one is made."""
    if exists(spark, source):
        _move(spark, source, target)
    system, done = _hadoop(spark, f"{target}/_SUCCESS")
    system.create(done, True).close()
