"""Readers: workbooks to cells, cells to statement facts, CSV tables."""
