"""Corvida: a PySpark-native engine for building and checking speech, translation and question-answering corpora."""
