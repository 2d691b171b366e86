"""helixframe.plans"""
