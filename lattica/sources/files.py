"""Files of local folders and of the stores that pyarrow opens, alike in the driver and in tasks."""

from __future__ import annotations

import glob
import os
from typing import BinaryIO


def local(path: str) -> str | None:
    """The plain path of a local file; none for a store's address."""
    if "://" not in path or path.startswith("file:"):
        return path.removeprefix("file://").removeprefix("file:")
    return None


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def open_read(path: str) -> BinaryIO:
    """A file that can be read anywhere in it."""
    plain = local(path)
    if plain is not None:
        return open(plain, "rb")
    system, inside = _store(path)
    return system.open_input_file(inside)


def open_write(path: str) -> BinaryIO:
    plain = local(path)
    if plain is not None:
        os.makedirs(os.path.dirname(plain) or ".", exist_ok=True)
        return open(plain, "wb")
    system, inside = _store(path)
    system.create_dir(inside.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inside)


def replace(source: str, target: str) -> None:
    """``source`` becomes ``target``, which is there before and after."""
    plain = local(target)
    if plain is not None:
        os.replace(local(source), plain)
        return
    system, inside = _store(target)
    system.move(_store(source)[1], inside)


def listed(path: str, suffix: str = ".zip") -> list[str]:
    """The files of a path: itself, those of its pattern, or all of its folder with the suffix."""
    plain = local(path)
    if plain is not None:
        return sorted(glob.glob(f"{plain}/*{suffix}") or glob.glob(plain))
    from pyarrow import fs

    system, inside = _store(path)
    if system.get_file_info(inside).type != fs.FileType.Directory:
        return [path]
    head = path.removesuffix(inside)
    return sorted(head + f.path for f in system.get_file_info(fs.FileSelector(inside)) if f.path.endswith(suffix))
