"""The library run on the supplied tables: orders as invoices, line items as payments."""
