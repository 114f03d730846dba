"""Operators for preparing large text corpora: cleaning, scanning, de-duplication, packing."""
