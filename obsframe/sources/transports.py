"""Transports that answer from stored files, for replays and tests."""

import json

from pyarrow import dataset, fs

PAGES_PER_FOLDER = 100


class StoredPages:
    """Pages kept as Parquet (page, body) in ``<folder>/pages/run=<page // 100>``, and the number of records as
    text ``{"count": n}`` in ``<folder>/count``. The last run that was read is kept in memory."""

    def __init__(self, folder: str):
        self.folder = folder
        self.run, self.bodies = None, {}

    def _open(self):
        if "://" in self.folder or self.folder.startswith("file:"):
            return fs.FileSystem.from_uri(self.folder)
        return fs.LocalFileSystem(), self.folder

    def count(self) -> int:
        system, root = self._open()
        parts = [f.path for f in system.get_file_info(fs.FileSelector(f"{root}/count")) if f.base_name.startswith("part-") and f.size]
        return json.loads(system.open_input_stream(parts[0]).read())["count"]

    def page(self, offset: int, limit: int) -> tuple[int, str | None]:
        number = offset // limit
        run = number // PAGES_PER_FOLDER
        if run != self.run:
            system, root = self._open()
            try:
                table = dataset.dataset(f"{root}/pages/run={run}", filesystem=system, format="parquet").to_table(["page", "body"])
            except FileNotFoundError:
                return 404, None
            self.run, self.bodies = run, dict(zip(table["page"].to_pylist(), table["body"].to_pylist()))
        body = self.bodies.get(number)
        return (404, None) if body is None else (200, body)
