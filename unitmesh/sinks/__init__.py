"""Writers: bulk batches, warehouse store, appends, JSON records."""
