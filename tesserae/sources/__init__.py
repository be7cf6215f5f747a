"""Readers: model modules, schemas, instances, registries, term tables, triples."""
