"""Ball-by-ball sports analytics and post sentiment as Spark DataFrame operators."""
