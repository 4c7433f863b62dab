"""Column functions: text, dates and the business rules built on them."""
