"""Building blocks: conforming rows, fact builds, aggregates, upserts, ledgers, audits."""
