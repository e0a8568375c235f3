"""Fixed values and options."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values. Results are only right if these stay as they are.
SEPARATORS = "[^a-z0-9]+"  # everything but ASCII letters and digits, after lower-casing
HASH_CHARSET = "UTF-16LE"  # characters are fed to SHA-1 low byte first
PHRASE_LENGTH = 4
TEXT_FILE_GLOB = "*.txt"
REPORT_LINE = "%7d %7d '%s'"  # documents, total, phrase
STATS_LINES = (
    "# uris                : %,d",
    "# unique documents    : %,d",
    "# processed documents : %,d",
)

# Raised whenever tokens or phrases of the same text would come out differently.
TOKENIZER_VERSION = 1


@dataclass(frozen=True)
class LedgerOptions:
    """Settings fixed when a ledger is created and stored with it.

    buckets: files per compacted table. Joins against a compacted table reuse
        its bucketing, so this is also their parallelism: on a cluster use a few
        times the number of cores, and at least spark.sql.shuffle.partitions.
        Ledger.compact can change it.
    """

    phrase_length: int = PHRASE_LENGTH
    buckets: int = 8
    tokenizer_version: int = TOKENIZER_VERSION

    def __post_init__(self):
        if self.phrase_length < 2:
            raise ValueError("phrase_length must be at least 2")
        if self.buckets < 1:
            raise ValueError("buckets must be at least 1")
