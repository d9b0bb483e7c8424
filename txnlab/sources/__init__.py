from txnlab.sources.transactions import (  # noqa: F401
    TRANSACTION_SCHEMA,
    add_row_key,
    read_stored_transactions,
    read_transactions,
    transactions_from_tables,
    write_transactions,
)
from txnlab.sources.results import (  # noqa: F401
    load_model,
    read_result,
    save_model,
    write_result,
)
