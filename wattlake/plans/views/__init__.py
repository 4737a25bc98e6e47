"""Dashboard, monitoring and quarantine views: each is a function of the tables it reads."""
