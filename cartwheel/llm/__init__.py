"""Training-data operators: one module per operator, nothing else imports them."""
