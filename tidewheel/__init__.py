"""tidewheel: customer, outlet and campaign analytics as plain Spark DataFrame functions."""
