"""Reading and writing line files, inventories, ledgers and logs."""
