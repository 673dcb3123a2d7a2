"""Where a lake keeps its files and log tables, and how large a unit of work is."""

from __future__ import annotations

from dataclasses import dataclass

# Names inside the exported data that a reader must know.
MANIFEST_FILE = "model.json"
OPTION_FILE = "Microsoft.Athena.TrickleFeedService/{entity}-EntityMetadata.json"
SYNC_STATE_KEY = "Athena:InitialSyncState"
SYNC_STATE_READY = "Completed"
SYNC_STATE_MISSING = "Unknown"
DECIMAL_TRAIT = "is.dataFormat.numeric.shaped"
GUARD_COLUMNS = ("SinkCreatedOn", "SinkModifiedOn")
KEY_COLUMNS = ("Id", "versionnumber")
DEFAULT_LANGUAGE = 1040
LAST_DATE = "2262-04-11"

MIB = 1024 * 1024
MAX_BLOCK_BYTES = 4000 * MIB


@dataclass(frozen=True)
class LakeConfig:
    """Paths are Hadoop paths or URIs that every executor can reach.

    ``chunk_bytes`` bounds the bytes one task scans, copies or parses;
    ``block_bytes`` bounds the bytes one task holds in memory at a time.
    """

    source_root: str
    range_root: str
    table_root: str
    log_schema: str = "appendlake"
    log_root: str | None = None
    chunk_bytes: int = 128 * MIB
    block_bytes: int = 100 * MIB
    bucket_count: int = 64

    def __post_init__(self) -> None:
        if not 1 <= self.block_bytes <= MAX_BLOCK_BYTES:
            raise ValueError(f"block_bytes must be between 1 and {MAX_BLOCK_BYTES}")
        if self.chunk_bytes < 1:
            raise ValueError("chunk_bytes must be positive")
        if self.bucket_count < 1:
            raise ValueError("bucket_count must be positive")
        for name in ("source_root", "range_root", "table_root", "log_root"):
            value = getattr(self, name)
            if value is not None:
                object.__setattr__(self, name, value.rstrip("/"))

    @property
    def copies(self) -> str:
        return f"{self.log_schema}.copies"

    @property
    def loads(self) -> str:
        return f"{self.log_schema}.loads"

    @property
    def load_files(self) -> str:
        return f"{self.log_schema}.load_files"

    @property
    def manifest_path(self) -> str:
        return f"{self.source_root}/{MANIFEST_FILE}"

    def option_path(self, entity: str) -> str:
        return f"{self.source_root}/{OPTION_FILE.format(entity=entity)}"
