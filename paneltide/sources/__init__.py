"""Readers (explicit schemas), the driver-table binding, and sinks."""
