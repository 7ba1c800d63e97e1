"""Readers, writers, file-name selection and keyed tables."""
