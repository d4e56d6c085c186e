from hypothesis import settings

settings.register_profile("no-deadline", deadline=None)  # first calls build tables
settings.load_profile("no-deadline")
