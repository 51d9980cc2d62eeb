"""Readers and writers of the dataset's file formats."""
