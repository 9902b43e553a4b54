"""Training-data operators: dedup, filters, models and tokenisation over the
``documents`` / ``benchmark`` / ``labels`` tables. Nothing else in the
package imports this subpackage."""
