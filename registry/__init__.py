"""Every operator as a query over the data folder, with its SQL counterpart."""
