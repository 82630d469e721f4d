"""Every operator as a query on the given tables, with the SQL that gives the same rows."""

from moorage.catalogue import csv_files, documents, manifests, patches, upserts

MODULES = [documents, upserts, manifests, csv_files, patches]

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
