"""larder: data-quality rules over product-like tables, written as Spark DataFrame jobs."""
