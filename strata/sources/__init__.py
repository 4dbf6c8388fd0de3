"""Readers: the driver's test tables mapped to reference shapes, and file scans."""
