"""Readers and writers: reports, manifest, versioned ledger, registry, CSV."""
