"""Single files opened inside tasks, by Arrow's file systems.

The functions are nested so that Spark sends them by value; executors need no copy of this package.
"""

from __future__ import annotations

from collections.abc import Callable


def _file_system() -> Callable:
    def file_system(path: str):
        """File system and inner path; executors need their own access to the store."""
        import re

        from pyarrow import fs

        scheme = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*):", path)
        if not scheme or scheme.group(1) == "file":
            return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))

    return file_system


def record_reader() -> Callable[[str], list[str] | None]:
    file_system = _file_system()

    def first_record(path: str) -> list[str] | None:
        """First CSV record of one file, without a byte order mark; only its first blocks are read. None if they are damaged."""
        import csv
        import io

        system, inner = file_system(path)
        codec = "gzip" if path.endswith(".gz") else None
        with system.open_input_stream(inner, compression=codec) as stream:
            try:
                return next(csv.reader(io.TextIOWrapper(stream, encoding="utf-8-sig", newline="")), None)
            except (OSError, UnicodeDecodeError, csv.Error):
                return None

    return first_record


def text_writer() -> Callable[[str, str], None]:
    file_system = _file_system()

    def write_text(path: str, text: str) -> None:
        """Write one small file whole; a retried task writes the same file again."""
        system, inner = file_system(path)
        system.create_dir(inner.rpartition("/")[0], recursive=True)
        with system.open_output_stream(inner) as stream:
            stream.write(text.encode("utf-8"))

    return write_text


def damage_finder() -> Callable[[str], str | None]:
    file_system = _file_system()

    def damage(path: str) -> str | None:
        """Why a file can't be read to its end, or None; blocks are read and dropped."""
        system, inner = file_system(path)
        codec = "gzip" if path.endswith(".gz") else None
        try:
            with system.open_input_stream(inner, compression=codec) as stream:
                while stream.read(1 << 20):
                    pass
        except OSError as error:
            return str(error)
        return None

    return damage
