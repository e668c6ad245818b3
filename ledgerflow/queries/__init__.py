"""Every registered query with the SQL that must give the same rows."""

from ledgerflow.queries import account, customer, load, quality, storage

QUERIES = {
    name: entry
    for module in (customer, account, quality, storage, load)
    for name, entry in module.QUERIES.items()
}
