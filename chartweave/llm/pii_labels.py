"""The labelled table that the personal-information model is trained from.

A set of sentences is marked up by hand: a slot in braces is filled from a rule, and the kinds in KINDS are labels.
Sentences without such a slot teach what is none (eponyms, order, lot, form and device numbers, dates).  Sentences and
fillings are written for this table; none is taken from a corpus that the model is used on.
"""

from __future__ import annotations

import random
import re

KINDS = ["email", "phone", "id", "address", "name"]

# Marked-up sentences.
WITH = """
Mr. {family} came in with {symptom}.
Mrs. {family} has had {symptom} since {date} and would like to {act}.
Ms. {family} wishes to {act}.
Ms. {family} wants us to {act} once {event} is over.
Mr. {family} reports that {symptom} improved with {drug}.
Miss {family} did not attend on {date}.
Dr. {family} recommended {drug} {dose} {often}.
Dr. {family} will {act} before {date}.
Dr. {name} thinks we should {act}.
I spoke to Dr. {name} on {date}, who will {act}.
Prof. {name} was consulted about the {site} {lesion}.
Dear {name}, thank you for seeing this patient with {symptom}.
Letter to {name}, {email}.
Sent by Dr. {family} because of {symptom}.
Dr. {family} asks for an opinion on {symptom}.
Nurse {name} came at {time}.
Social worker {name} comes on {date}, {role} {name} after that.
Reply by {email} or {phone}, or write to {address}.
Known as {name} since {date}.
{name} {label} {id} DOB {date}
{name}, {label} {id}
Booked for {name} by {phone}.
Copies go to {name} and {name}.
cc {name}, {email}
cc: {name}
CC: {name} / {phone}
cc: {name} / tel {phone} / {room}
fax {phone}, attention {name}
Dictated by {name} on {date} at {time}.
Signed by {name} at {time} on {date}.
Electronically verified by {name}, {credential}, {date} {time}.
Reviewed with {name} and {name}.
Attending: {name}. Resident: {name}. {role} covering until {time}.
Surgeon {name}, assistant {name}, {role} present in {room}.
Shift passed from {name} to {name} at {time} in {room}.
{name} called from {phone} about {lab} {num}.
{name} was paged on {phone} about a {lab} of {num}.
{name} can be reached on {phone}.
{name}, the neighbour, found the patient {mood} at {time} and phoned {phone}.
The son, {name}, lives at {address}.
The patient's sister {name} wrote from {email} and wants to {act}.
Pt's cousin {name} emailed from {email} to {act}.
Husband {name} says that {name} has taken {drug} {often}.
Wife {name} confirms {drug} {dose} {often}.
The patient was brought by her daughter {name}, phone {phone}.
{name} was accompanied by a friend, {name}, who left {phone}.
Emergency contact: {name}, {phone}, {email}.
Next of kin {name} ({phone}) prefers letters to {address}.
Next of kin is {name} ({phone}); write to {email}.
Contact person {name} ({phone}).
Please ring {phone} after {time}.
Call back on {phone} requested, {mood}.
Voicemail left at {phone} on {date}.
Message left ({phone}) at {time}; a copy was posted to {address}.
Text reminder sent to {phone}.
Home {phone}, work {phone}.
Mobile {phone} is no longer in use.
Will ring {phone} if {symptom} comes back.
Spoke with {name} about {symptom}, to call {phone} if worse.
Talked w/ {name} re {symptom}, who will phone {phone}.
Send the {lab} to {email}.
Questions about {drug} can go to {email} until {date}.
{symptom} began after {event}, according to a message from {email}.
The mother, as {name} writes from {email}, noticed {symptom}.
Lives at {address}.
Has moved to {address}; the {role} has been told.
New address: {address}; old one {address}.
Write to ({address}) by {date}.
Picked up from {address} by a driver at {time}.
The home is {address}, phone {phone}.
A copy of the {lab} result went to {address}.
Address on file: {address}.
Postal address {address}.
Home visit planned at {address} on {date}, {role} informed.
Moved to {address} in {date}; {role} to change the record.
Transport from {address} ordered for {time}, driver reached at {phone}.
Ambulance sent to {address} at {time}.
Deliveries go to {address}.
Bus from {address} booked for {time}, {role} rides along.
A car from {address} is set for {time}.
Parcel to {address} returned on {date}.
Checked: {name}, {label} {id}, home {address}.
Birth date {date}, {label} {id}, home {address}
Residence {address}.
Patient {name}, {label} {id}, born {date}.
Patient: {name}, {label} {id}, admitted {date} {time}.
PATIENT {name} {label} {id}
Name: {name}. {label} {id}. Address: {address}.
{label} {id}
{label} {id} in the name of {name}.
The insurance card bears {label} {id} below the name {name}.
Asked for {label} {id}, told {label} {id}.
{label} {id} was confirmed by {name}.
Identity checked: {name}, {label} {id}, {address}.
The card lists {label} {id} and {phone}.
The scan shows {label} {id} issued to {name}.
Coverage was confirmed under {label} {id}, reference {accession}, for {drug} {dose}.
The insurer asked about {label} {id}, case {accession}, {drug} {dose}.
Registered with {label} {id} and phone {phone}.
Interpreter arranged with {name}, {phone}, for {date}.
Interpreter for {name} by {phone} on {date}.
As {name} advised, {drug} {dose} continues {often}.
Per {name} we {act}.
{name} to {act} when {lab} returns; {name} informed.
{name} agrees to {act}.
{name}
{name} informed, {name} not yet.
When {lab} is known, {name} will {act}; {name} has been asked.
Partner {name} says that {name} is {mood}.
Uncle {name} sent {email} and {phone}.
Pt's nephew {name} texted from {phone}.
{name} performed the {thing} in {room}.
History given by {name}.
"""
WITHOUT = """
The {eponym} {thing} was {n}, formerly {n}.
{eponym} {thing} {n} on {date}, {eponym} {thing} {n} on {date}.
{eponym} {thing} of {n} with {symptom}.
A {eponym} {device} was placed at {time}; {n} mL drained.
The {eponym} {device} was changed, lot {lot}, and {n} mL came out.
The {eponym} {device} is to be removed on {date}.
{eponym} {device} in place, output {n} mL, skin {look}.
Positive {eponym} {thing} and negative {eponym} {thing}.
{eponym} disease was ruled out; {eponym} criteria were not met.
Wound of the {site} {look}, {n} mL, {eponym} {device} stays.
Gait {look}, {eponym} {thing} {n}, grip strength {num} kg.
{n} way tap changed; {eponym} {device} flushed.
{n} Lead tracing unchanged, {n} Road tests passed in the simulator.
Pathway {street} Road clinic, {n} steps, form {form}.
Refer to the {street} Road clinic guide, {n} pages.
The {plain} Street Clinic opens on {date} and shares {room} with the {plain} Unit.
{plain} Unit rota from {date}, {plain} ward on {date}.
The {plain} Lane Surgery and the {street} Avenue Centre have moved.
Ratio @ rest {num}, ratio @ peak {num}.
Dose @ {time} was {dose}; rate @ {n} mL.
Protocol {code}-{n}-{n}, arm B, version {n}.0.{n}.
Study {code}-{n}, cohort {n}, amendment 2.{n}.{n}.
Pump serial {n}-{two}-{four}-{n} alarmed {n} times.
Device number {n}-{two}-{four}, software 3.{n}.{n}.
Monitor serial no. {n}-{two}-{four}-{n} was replaced.
Specimen {accession}, lot {lot}, catalogue no. {catalogue}, arrived at {time}.
Reagent lot {lot}, catalogue {catalogue}, expires {date}.
Order {n}-{two} for {drug} checked by the {role} at {time}.
Order {eight} supersedes order {eight}.
Order no. {eight} was cancelled, replaced by {eight}; visit closed {date} {time}.
Encounter {eight} closed on {date}.
Requisition {eight}, accession {accession}.
Pathology {accession}: {look} {lesion} of the {site}, margin {num} mm.
{accession} shows a {look} {lesion}, {n} x {n} mm, in the {site}.
Imaging {accession} of {date} with a {lesion} of the {site}, {n} x {n} mm before.
Scan {accession}: the {site} is {look}.
Biopsy {accession} taken from the {site} on {date}.
Examination found a {look} {lesion} of the {site}, {n} x {n} mm.
The {site} is free of any {lesion}; the {site} shows a {look} {lesion}.
Ultrasound: {look} {lesion} of the {site}, {n} percent larger.
Blood pressure {n}/{n}, pulse {n}, temperature {num}, saturation {n} percent.
Seen at {time} in {room}, {mood}, pressure {n}/{n}.
{mood} at {time}, {room}.
Released at {time} to {room}.
The {role} brought {drug} to {room}.
{drug} was checked at {time}, then taken to {room}.
“{hobby}” – {mood}, {room}.
Tel {lab} desk, {room}.
The {role} was told to {act}; leaflet {lot} was given in {room}.
{n} doses of {drug} are left; the {role} will {act} by {date}.
{lab} went from {num} to {num} between {date} and {date}, {drug} paused.
Labs: {lab} {num}, {lab} {n}, {lab} {num} ({num} on {date}).
Aim for {lab} ≤ {n} µmol/L; {num} ± {num} at {time} – naïve to {drug}.
{drug} {dose} {often} continues; {drug} ended on {date} for {symptom}.
{drug} trough {num} on {date}, {drug} peak {num}, range {n} to {n}.
{drug} {n} µg {often} – cut by ≥ {n} % after {lab} {num} × 10⁹/L.
At {time} {drug} {dose} was given over {n} minutes.
Allergic to {drug}; {drug} {dose} caused {symptom}.
No {symptom}, {symptom} or {symptom}; {symptom} {n} times a month.
Denied {word}, {word} and {word}, reports {word} or {word}.
Complains of {word}, {word} and {symptom}; no {word}.
{drug} {dose} ran for {n} minutes, {word}, {lab} at {time}.
Went well, {word}, {lab} to follow.
The patient {hobby} and wonders whether to {act} after {event}.
The patient, who {hobby}, has {symptom} and wants to {act}.
Since {event} there is {symptom}; the patient {hobby} and climbs {n} stairs.
In the patient’s words: “I {hobby}, it’s the {symptom}” – {mood}.
The family’s worry is “{symptom}”, {num} °C at {time}.
Weight {num} kg, {symptom} two days after {event}.
{symptom} was mild until {event}; {symptom} has eased and {drug} helps.
{symptom} peaked around {event} and comes and goes.
{symptom} wakes the patient {n} times a night, {drug} {dose} helps for {n} minutes.
The {role} saw that {drug} {often} was left out {n} times after {event}.
The {role} looked at the {drug} plan and asked us to {act}.
Within {n} days we {act}, and {act} if {lab} is under {num}.
The choice is to {act} or to {act}; the family would {act} first.
{n} fractions to the {site} ended {date}.
The {site} was treated with {drug}, {symptom} as side effect.
This document was made with speech recognition and may hold errors.
Results are released under the standing rule of the department.
The desk is open on weekdays; please ask there if anything is unclear.
Carried over from {date}.
Carried forward {date}, checked in {room}.
Assessment:
Plan and follow-up
# Summary
History of the present illness
SUBJECTIVE:
FINDINGS
Medications on admission:
-------- Original message {date}
Re: Fwd: {drug} refill
| {lab} {num} on {date} | {lab} {num} |
{blob}
{blob}
"""
AUTHORS = """
{name}
{name}
{name}
{name}, {credential}
{name} {credential}
Dr. {name}
Prof. {name}
{name} <{email}>
{name}, {credential} <{email}>
{name} ({email})
{name}, {credential}, pager {phone}
{name} pgr {phone}
{name}, {credential} pgr {phone}
{name} tel {phone}
Dr. {name}, {phone}
Dr. {name} <{email}>
Dr. {name} pgr {phone}
WARD CLERK POOL
INTERFACE, RADIOLOGY
LAB INTERFACE
SYSTEM, BATCH
Nursing Pool 3 North
Pharmacy Queue
Refill Queue West
OUTSIDE RECORD
Medical Scribe
Scanning Department
Day Team 4 South
DICTATION SERVICE
Import Service
CARE DESK
"""
# Fillings of the slots without a label.
FILL = {
    "symptom": "chest tightness|a sore throat|vomiting|swollen knees|stiff neck|blisters|poor appetite|a rash|cramps|insomnia|fever|chills|tinnitus|sneezing|weakness|a limp|joint pain|heartburn|tremor|wheezing|weight loss|constipation|fainting|jaw pain|low mood|shortness of breath",
    "act": "change the dressing|stop the infusion|start physiotherapy|order a scan|check the blood count|add a laxative|delay the next cycle|see a dietitian|ask for old slides|repeat the culture|book a follow-up|wean the steroid|try a lower dose|measure the level|discuss at the conference|send a referral|flush the line",
    "event": "surgery|the holidays|the second dose|the accident|vaccination|the first cycle|moving house|the transfusion|her wedding|the winter|antibiotics|the biopsy|admission|a long flight|the dose change|their anniversary|the operation",
    "mood": "relaxed|worried|cheery|low|alert|irritable|confused|in good spirits|exhausted|friendly|silent|upset",
    "role": "nurse|therapist|porter|pharmacy technician|care coordinator|trial nurse|secretary|chaplain|intern|dosimetrist|phlebotomist|ward sister",
    "room": "Room 7|Bed 12|Ward C|Theatre 3|Clinic 5|Suite 21|Bay 9|the recovery area|2 South|6 North|Unit 8|the waiting room",
    "lab": "glucose|urea|INR|lipase|ferritin|sodium|potassium|haemoglobin|white cells|CRP|chloride|phosphate|bilirubin|calcium|creatinine|TSH|albumin|D-dimer",
    "often": "every morning|three times a day|nightly|every eight hours|once a week|on alternate days|when needed|after meals|on days 1 to 5|monthly",
    "eponym": "Foley|Apgar|Hodgkin|Jackson-Pratt|Karnofsky|Glasgow|Murphy|Babinski|Gleason|Doppler|Braden|Crohn|Hickman|Norton|Kocher|Weber|Rinne|Swan-Ganz|Romberg|Barthel|Penrose|Burch-Wartofsky",
    "thing": "score|sign|test|scale|index|grade|stage|criteria",
    "device": "catheter|drain|line|port|pump|tube|stent|clamp|splint|valve",
    "look": "round|soft|solid|dark|uneven|smaller|larger|well-circumscribed|calcified|hyperechoic|lobed|unchanged|painful|hard|mobile|vague|bright|thin|dense|diffuse",
    "lesion": "lump|tumour|cyst|polyp|scar|stenosis|opacity|swelling|haematoma|effusion|abscess|lymph node|erosion|fistula|nodule|mass|thickening",
    "site": "right knee|left breast|upper lobe|liver|gastric antrum|prostate|femoral neck|neck|lower spine|caecum|spleen|bile duct|tongue base|shoulder blade|groin|aorta|bladder wall|ovary|kidney|frontal sinus|left hip|anterior tibia",
    "hobby": "plays chess|works as a plumber|grows tomatoes|rides horses|teaches maths|collects stamps|runs a farm|swims daily|drives trucks|bakes bread|repairs radios|looks after a grandson|sings|paints|sells shoes|builds fences",
    "credential": "MD|DO|RN|NP|PhD|PA-C|PharmD|MBBS",
    "plain": "Queen|Church|Forest|River|North|Meadow|Abbey|Chapel|Market|Garden|Bridge|Park|Hill|Stone|Winter|Field",
    "way": "Road|Rd|Ave|Avenue|Lane|Ln|Street|St|Drive|Way|Court|Blvd|Row|Place|Close|Crescent",
    "label": "SSN|SSN:|SSN#|social security|social security no.|soc. sec. no.|soc sec|MRN|MRN:|MRN#|MRN no.|chart no.|chart number|record number|medical record|insurance member|insurance member no.|policy holder number|policy number|Member ID:|member no.|member number|ID|ID:|identity|identity no.",
}
GIVEN = "Anna Peter Maria José Thomas Ingrid Pierre Chloé Hans Olga Ivan Emily Jack Sofia Liam Noah Mia Zoë Lukas Marta Piotr Agnieszka Paulo Inês Carlos Lucía François Élodie Yuki Hiro Ahmed Fatima Wei Priya Arjun Grace Henry Alice George Martha Walter Ruth Oscar Clara Victor Nina Jonas Freya Tobias Greta Sven Astrid Mateo Elena Hugo Iris Max Ida Leo Eva".split()
COMMON_FAMILIES = "Smith Brown Green Young King Baker Cook Day May Rose Park Bush Bell Stone Wood Hill Field Page Winter Marsh Brook Palmer Long Short Price".split()
FAMILIES = "Johnson Williams Martínez García Müller Schröder Nowak Kowalski Silva Gonçalves Rossi Dubois Lefèvre Novák Petrov Ivanova Andersson Sørensen Nguyen Patel Singh Kim Tanaka O'Brien MacDonald Fitzgerald Hernández Richardson Thompson Whitaker Underwood Abernathy Castellano Ferreira Lindqvist Bjørnstad Czerny Dąbrowski".split()
ONSETS, MIDDLES, ENDS = "B C D F G H K L M N P R S T V W Br Ch Cr Gr Sch Sh Sl Tr Wh Y".split(), "a e i o u ai ea oo ie an er il on ul am".split(), "son ton ley man berg wick ford stein ski ova ez ini eau sen ham worth ö ing ering ry dottir quist low ris nen bury gate".split()
PLACES, KINDS_OF_PLACE = "Oak Maple Elm Cedar Lake River Spring Church High Chestnut Rose Willow Bay Hunter Castle Orchard North West Silver Harbour".split(), "side wood view field brook dale mont stead haven crest".split()
TOWN_ENDS = "ton ville burg field mouth bridge borough shire haven port stad wald".split()
STEMS, STEM_ENDS = "ato lisi meto ome rami simva cefa doxy flu hydro keto levo nilo oxa pred rosu tacro valga zol ibu".split(), "statin pril lol prazole mab nib cillin cycline sone zine pine tidine platin taxel".split()

class Filler:
    """Fills the slots of marked-up sentences; names come from the roster, too, where one is given."""

    def __init__(self, seed: int, given: list[str] = (), family: list[str] = ()):
        self.r = random.Random(seed)
        self.given, self.family = [*GIVEN, *given], list(family)

    def pick(self, slot: str) -> str:
        return self.r.choice(FILL[slot].split("|"))

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def surname(self) -> str:
        k = self.r.random()
        if k < 0.15:
            return self.r.choice(COMMON_FAMILIES)
        if k < 0.3:
            return self.r.choice(FAMILIES)
        if k < 0.6 and self.family:
            return self.r.choice(self.family)
        return self.r.choice(ONSETS) + self.r.choice(MIDDLES) + self.r.choice(["", "", "d", "l", "n", "r", "tt", "v"]) + self.r.choice(ENDS)

    def street(self) -> str:
        r = self.r
        made = r.choice(PLACES) + r.choice(["", r.choice(KINDS_OF_PLACE)])
        return r.choice([made, made, f"{r.choice(PLACES)} {r.choice(PLACES).lower().capitalize()}", f"Old {made}", f"{self.surname().capitalize()}'s"])

    def town(self) -> str:
        made = self.r.choice(ONSETS) + self.r.choice(MIDDLES) + self.r.choice(["l", "n", "r", "s"]) + self.r.choice(TOWN_ENDS)
        return self.r.choice([made, made, f"{self.r.choice(['Upper', 'Lower', 'North', 'St.', 'New', 'Port'])} {made}", f"{made} {self.r.choice(['Ridge', 'Bay', 'Falls', 'Heights'])}"])

    def host(self) -> str:
        r = self.r
        words = [w.lower() for w in (r.choice(PLACES), r.choice(KINDS_OF_PLACE), self.town().split()[-1])]
        name = r.choice([words[2], "-".join(words[::2]), "".join(words[:2]), f"{r.choice(['mail', 'post', 'home', 'my'])}.{words[2]}", f"{words[2]}-clinic"])
        return f"{name}.{r.choice(['example', 'test', 'invalid', 'com', 'org', 'net', 'de'])}"

    def fill(self, slot: str) -> str:
        r, d = self.r, self.digits
        if slot == "eponym" and r.random() < 0.6:
            made = self.surname().capitalize()
            return f"{made}-{self.surname().capitalize()}" if r.random() < 0.15 else made
        if slot == "room" and r.random() < 0.5:
            return f"{r.choice(['Ward', 'Clinic', 'Bay', 'Unit', 'Bed', 'Theatre', 'Room'])} {r.choice(['A', 'B', 'C', 'D', 'E', str(r.randint(1, 400))])}"
        if slot in FILL:
            return self.pick(slot)
        if slot == "family":
            return self.surname()
        if slot == "name":
            # some given names are in no list; in lower case or capitals such a name would be like any other word
            new = r.random() < 0.12
            g, f = self.made_up("A") if new else r.choice(self.given), self.surname()
            made = r.choices([f"{g} {f}", f"{g} {r.choice('ABERTM')}. {f}", f"{f}, {g}", f"{f},{g}", f"{g[0]}. {f}", f"{f}, {g} {r.choice('ABRT')}."], [8, 3, 4, 2, 3, 1])[0]
            return r.choices([made, made.upper(), made.lower()], [6, 1 if new else 3, 0 if new else 3])[0]
        if slot == "phone":
            a, m, b = str(r.randint(200, 999)), r.choice(["555", d(3)]), d(4)
            return r.choice([f"({a}) {m}-{b}", f"{a}-{m}-{b}", f"{a}.{m}.{b}", f"{a}{m}{b}", f"{a}{m}{b}", f"+1 {a} {m} {b}", f"1-{a}-{m}-{b}", f"+44 {d(2)} {d(4)} {d(4)}", f"+49 {d(2)} {d(5)}-{d(3)}", f"0{d(2)} {d(5)} {d(3)}"])
        if slot == "email":
            g, f, host = r.choice(self.given).lower(), self.surname().lower(), self.host()
            user = r.choice([f"{g}.{f}", f"{f}.{g[0]}", f"{f}_{g}{d(2)}", f"{g}+chart", f"{g}-{f}", f"{g[0]}{f}"])
            made = f"{user}@{host}"
            k = r.random()
            return made.upper() if k < 0.15 else f"{user}(at){host}" if k < 0.3 else f"{user} [at] {host.replace('.', ' [dot] ')}" if k < 0.45 else made
        if slot == "id":
            ssn = r.choice([f"{d(3)}-{d(2)}-{d(4)}", f"{d(3)} {d(2)} {d(4)}", d(9)])
            letters = "".join(r.choice("ABCDEFGHJKLMNPQRSTVWXYZ") for _ in range(r.choice([2, 3])))
            return r.choice([ssn, ssn, "000" + d(5), "00" + d(6), d(8), f"{letters}{d(4)}-{d(4)}-{d(1)}", f"{letters} {d(3)} {d(4)} {d(2)}", f"{letters}{d(9)}"])
        if slot == "address":
            n, town, code, state = str(r.randint(2, 9800)), self.town(), d(5), r.choice(["CO", "CA", "NY", "TX", "OH", "WA"])
            flat = r.choice(["", "", f", Apt {r.randint(1, 30)}{r.choice(['', 'A', 'B'])}", f", Unit {r.randint(1, 99)}"])
            k = r.random()
            if k < 0.1:
                return f"P.O. Box {n}, {town}, {state} {code}"
            if k < 0.22:
                road = r.choice(["Linden", "Garten", "Berg", "Mühl", "Schiller", "Kirch", "Birken", "Wiesen"]) + r.choice(["weg", "straße", "gasse", "grund", "stieg", "zeile", "allee"])
                road = r.choice([road, road, f"Am {road.capitalize()}", f"Rue du {r.choice(['Moulin', 'Port', 'Lac'])}", f"Rue des {r.choice(['Lilas', 'Roses', 'Pins'])}"])
                return f"{road} {r.randint(1, 190)}, {code} {town}"
            head = f"{n} {self.street()} {self.pick('way')}{flat}"
            post = f"{''.join(r.choice('ABGHLMNS') for _ in range(2))}{d(1)} {d(1)}{''.join(r.choice('ABDEHLNPQRTUXYZ') for _ in range(2))}"
            return head + r.choice([f", {town}, {state} {code}", f"\n{town}, {state} {code}", f", {town}", f", {town} {code}", f", {town} {post}"])
        if slot == "date":
            return f"20{r.randint(17, 26)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}"
        if slot == "time":
            return f"{r.randint(0, 23):02}:{r.randint(0, 59):02}"
        if slot == "n":
            return str(r.choice([r.randint(2, 99), r.randint(2, 999)]))
        if slot == "word":
            return self.made_up("a")
        if slot == "street":
            return self.street()
        if slot == "code":
            return "".join(r.choice("ABCDEFGHKLMNPRSTX") for _ in range(3))
        if slot == "num":
            return f"{r.randint(0, 14)}.{r.randint(0, 9)}"
        if slot == "dose":
            return f"{r.choice([5 * r.randint(1, 98), r.randint(1, 900)])} {r.choice(['mg', 'mcg', 'mL', 'units'])}"
        if slot == "drug":
            return r.choice(STEMS) + r.choice(["", "", "xi", "la", "ro"]) + r.choice(STEM_ENDS)
        if slot == "accession":
            return f"{r.choice('SMRX')}{r.randint(18, 26)}-{d(5)}"
        if slot == "blob":
            return "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(r.randint(40, 90)))
        return {"lot": f"{d(4)}-{d(3)}-{r.choice('ABCDEFGHK')}", "form": f"{d(4)}-{d(4)}", "catalogue": f"{d(5)}-{d(4)}-{d(2)}", "two": d(2), "four": d(4), "eight": str(r.randint(10**6, 10**8))}[slot]

    def made_up(self, word: str) -> str:
        """A word that nobody knows, with the case of the given one: what stands around an item is mostly new."""
        r = self.r
        made = "".join(r.choice("b c d f g h l m n p r s t v st tr pl ch".split()) + r.choice("a e i o u ea ou".split()) for _ in range(r.choice([2, 2, 3]))) + r.choice(["", "n", "s", "t", "ed", "ing", "er", "ly", "tion", "al"])
        return made.capitalize() if word[0].isupper() else made

    def varied(self, text: str) -> str:
        """Some of the longer words made up."""
        return re.sub(r"[^\W\d_]{4,}", lambda m: self.made_up(m[0]) if m[0][1:].islower() and self.r.random() < 0.3 else m[0], text)

    def sentence(self, marked: str) -> tuple[str, list[tuple[int, int, str]]]:
        """Text and ``(start, end, kind)`` of its labels."""
        out, spans, n = [], [], 0
        for part in re.split(r"(\{\w+\})", marked):
            if part.startswith("{"):
                slot = part[1:-1]
                part = self.fill(slot)
                kind = "name" if slot == "family" else slot
                if kind in KINDS:
                    spans.append((n, n + len(part), kind))
                elif self.r.random() < 0.6:
                    part = self.varied(part)
            else:
                part = self.varied(part)
            out.append(part)
            n += len(part)
        text = "".join(out)
        return (text.upper(), spans) if self.r.random() < 0.14 and len(text.upper()) == len(text) else (text, spans)


def labelled_rows(rows: int = 1800, seed: int = 11, given: list[str] = (), family: list[str] = ()) -> list[tuple[str, str, list[tuple[int, int, str]]]]:
    """``(field, text, spans)``: ``rows`` texts of a few sentences each, a fifth of them authors."""
    f = Filler(seed, given, family)
    pos, neg, who = (s.strip().split("\n") for s in (WITH, WITHOUT, AUTHORS))
    out = []
    for k in range(rows):
        if k % 5 == 4:
            out.append(("author", *f.sentence(f.r.choice(who))))
            continue
        text, spans = "", []
        for _ in range(3):
            t, s = f.sentence(f.r.choice(pos if f.r.random() < 0.6 else neg))
            gap = f.r.choice([" ", " ", "\n", "\n\n", "\r\n", "  ", "\n- ", "\n* "]) if text else ""
            base = len(text) + len(gap)
            spans += [(a + base, z + base, kind) for a, z, kind in s]
            text += gap + t
        out.append(("text", text, spans))
    return out
